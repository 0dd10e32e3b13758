"""Landing-shaped copies of the driver tables, written by Spark to the shared
scratch folder, for the keys that exercise the raw-record path (JSON
landing, localisation, bronze writes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..conf import scratch_path
from ..functions.time import ntz_from_micros, utc_wallclock, wall_micros
from ..sinks import freed_shuffles
from ..sources.adapters import m_events, m_lineitem
from ..sources.landing import FETCH_MONTH
from ..sources.tables import load

# The autumn 2026 change of Europe/Athens (04:00 local summer
# time -> 03:00 winter time, at 01:00 UTC).  The events month is squeezed
# into the six hours from 22:00 UTC the evening before.
AUTUMN_WINDOW_START_UTC = "2026-10-24 22:00:00"
SQUEEZE = 120  # 30 days -> 6 hours
# The same change a year earlier, and the start of a night on which clocks go
# forward (03:00 -> 04:00 local, at 01:00 UTC).
EARLIER_AUTUMN_START_UTC = "2025-10-25 22:00:00"
SPRING_WINDOW_START_LOCAL = "2026-03-29 00:00:00"

# A landing file holds so many records at most: JSON takes ten times the room
# when it isn't compressed, and a compressed file is read by one task.
FILE_RECORDS = 1_000_000

ID_AS_FLOAT = ("connection_postal_code", "connection_municipality_id",
               "connection_regional_unit_id", "connection_periphery_id")


def as_api_records(df: DataFrame) -> DataFrame:
    """What the measurement service sends: local wall-clock text without an
    offset, ``connection_id`` as a JSON integer and the other ids as JSON
    floats (``19016.0``)."""
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return df.withColumns({
        "measurement_time": F.date_format("measurement_time", fmt),
        "connection_id": F.col("connection_id").cast("long"),
        **{c: F.col(c).cast("double") for c in ID_AS_FLOAT},
    })


def _write_json(df: DataFrame, path: str, mode: str = "overwrite", folders: tuple[str, ...] = ()) -> None:
    (df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
     .partitionBy(*folders).json(path))


def write_landing(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        _write_json(df, path)
    return path


def autumn_instants(spark: SparkSession, sf_dir: str, begin: str = AUTUMN_WINDOW_START_UTC) -> DataFrame:
    """``m_events`` moved onto the autumn change (or to ``begin``): the instant of each event is
    ``start + (ts - first ts) / 120`` (UTC, as ``timestamp_ntz``), so the local
    wall clock passes 03:00-03:59 twice."""
    ev = m_events(spark, sf_dir)
    first = ev.agg(F.min("measurement_time").alias("t0"))
    start = wall_micros(F.lit(begin).cast("timestamp_ntz"))
    micros = start + F.floor((wall_micros("measurement_time") - wall_micros("t0")) / SQUEEZE)
    return (ev.withColumn("t0", first.select("t0").scalar())
            .withColumn("utc_time", ntz_from_micros(micros.cast("long"))).drop("t0"))


def arrival(utc_ntz):
    """Number that grows with arrival: tests arrive when they are made, in
    whatever order their ids were given."""
    return wall_micros(utc_ntz)


def local_text(utc_ntz, tz: str = "Europe/Athens", with_offset: bool = False):
    """Wall-clock text in ``tz`` of a UTC ``timestamp_ntz`` (optionally with
    its ``+hh:mm`` offset), as a device in that zone would print it."""
    inst = F.timestamp_micros(wall_micros(utc_ntz))
    local = utc_wallclock(F.from_utc_timestamp(inst, tz))
    txt = F.date_format(local, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if not with_offset:
        return txt
    off_min = F.floor((wall_micros(local) - wall_micros(utc_ntz)) / 60_000_000).cast("int")
    sign = F.when(off_min < 0, F.lit("-")).otherwise(F.lit("+"))
    hh = F.lpad(F.floor(F.abs(off_min) / 60).cast("string"), 2, "0")
    mm = F.lpad((F.abs(off_min) % 60).cast("string"), 2, "0")
    return F.concat(txt, sign, hh, F.lit(":"), mm)


def lineitem_landing(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    """``m_lineitem`` as landing JSON (ship dates are local midnights), over
    ``files`` files if given, or more where they would get too large."""
    records = as_api_records(m_lineitem(spark, sf_dir))
    return write_landing(spark, _over_files(spark, sf_dir, records, files) if files else records,
                         "landing-lineitem")


def _over_files(spark: SparkSession, sf_dir: str, records: DataFrame, files: int) -> DataFrame:
    """Records of ``m_lineitem`` dealt over ``files`` files, or as many as
    ``FILE_RECORDS`` needs."""
    return records.repartition(max(files, -(-load(spark, sf_dir, "lineitem").count() // FILE_RECORDS)))


def drop_again(spark: SparkSession, sf_dir: str, landing: str, month: str | None = None,
               more_mbps: float = 0.0) -> None:
    """The records of ``m_lineitem`` (of one month, if given) once more, as
    further files of ``landing``, each speed raised by ``more_mbps``."""
    rows = as_api_records(m_lineitem(spark, sf_dir))
    if month:
        rows = rows.where(F.col("measurement_time").startswith(month))
    speed = F.col("measured_downstream_mbps")
    rows = rows.withColumn("measured_downstream_mbps", speed + F.lit(more_mbps))
    with freed_shuffles(spark):
        _write_json(_over_files(spark, sf_dir, rows, 3), landing, "append")


def lineitem_landing_by_month(spark: SparkSession, sf_dir: str) -> str:
    """The same in folders of the month that was asked of the source."""
    path = scratch_path(spark, "landing-months")
    rows = as_api_records(m_lineitem(spark, sf_dir))
    rows = rows.withColumn(FETCH_MONTH, F.substring("measurement_time", 1, 7))
    with freed_shuffles(spark):
        _write_json(rows.hint("rebalance", FETCH_MONTH), path, folders=(FETCH_MONTH,))
    return path


def unusable_month(spark: SparkSession, sf_dir: str, month: str) -> str:
    """One month delivered anew, every row with an impossible speed."""
    rows = as_api_records(m_lineitem(spark, sf_dir)).where(F.col("measurement_time").startswith(month))
    return write_landing(spark, rows.withColumn("measured_downstream_mbps", F.lit(-1.0)), "landing-unusable")


def events_landing(spark: SparkSession, sf_dir: str) -> str:
    return write_landing(spark, as_api_records(m_events(spark, sf_dir)), "landing-events")
