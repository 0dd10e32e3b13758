"""Batch jobs: landing -> bronze (entry 1) and bronze -> silver -> gold
(entry 2).  Each job is one lazy plan per written table; every later step
reads the table written before it, which cuts the lineage (a lost executor
only re-runs the current step) and keeps the session build from being
computed three times."""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from ..conf import scratch_path, scratch_root
from ..functions.time import localize, settle_overlap, utc_wallclock, wall_micros
from ..operators.gold import frustration_staircase, regional_metrics, user_retention
from ..operators.sessions import (bucket_partials, first_seconds, resumed_sessions, session_cuts,
                                  sessions_from_partials, timeout_seconds, unchanged_sessions)
from ..operators.silver import clean_measurements
from ..schema import BRONZE_SCHEMA, PARTITION_KEYS, RAW_SCHEMA, SchemaMismatch, conform
from ..sinks import delete, finish, freed_shuffles, replace_in_two_passes, replace_months, write_table
from ..sources.landing import FETCH_MONTH, missing_fields, read_bronze, read_landing

TABLES = ("silver_measurements", "silver_user_sessions", "gold_regional_metrics",
          "gold_user_retention", "gold_frustration_staircase")
# Helper table: per (user, month, 30-minute bucket) partials of silver, so a
# monthly refresh aggregates only the new months' rows.
PARTIALS = "silver_session_buckets"


def _ym(month: str) -> tuple[int, int]:
    y, m = month.split("-")
    return int(y), int(m)


def _in_months(year_col, month_col, months) -> F.Column:
    """The (year, month) columns are one of ``months``; a plain comparison of
    folder keys, so it prunes."""
    found = F.lit(False)
    for y, m in sorted(set(months)):
        found = found | ((year_col == y) & (month_col == m))
    return found


def _month_keys(localized: DataFrame, tz: str, start: str | None = None) -> dict[str, F.Column]:
    """``year`` and ``month`` under which bronze stores a row, see ``to_bronze``."""
    asked = F.to_date(F.col(FETCH_MONTH), "yyyy-MM") if FETCH_MONTH in localized.columns \
        else F.lit(None).cast("date")
    local = F.to_date(utc_wallclock(F.from_utc_timestamp(F.col("measurement_time"), tz)))
    first = F.lit(start + "-01" if start else None).cast("date")
    month = F.coalesce(asked, local, first)
    return {"year": F.year(month), "month": F.month(month)}


def with_months(raw: DataFrame, tz: str = "Europe/Athens") -> DataFrame:
    """Raw records, of which only the time is looked at, with the ``year`` and
    ``month`` that ``to_bronze`` gives them: which offset an overlap hour takes
    can't move a row to another month."""
    at = localize(raw.withColumn("said", F.col("measurement_time")), "measurement_time", tz=tz, ambiguous="earlier")
    return (at.withColumns(_month_keys(at, tz)).withColumn("measurement_time", F.col("said")).drop("said"))


def to_bronze(raw: DataFrame, tz: str = "Europe/Athens", ambiguous: str = "infer",
              ingested_at: _dt.datetime | None = None,
              start: str | None = None, end: str | None = None,
              also: tuple[str, ...] = (), flag: str | None = None,
              seen: Observation | None = None) -> DataFrame:
    """Raw records -> typed bronze rows with the ``year`` / ``month`` they are
    stored under.

    That is the month that was asked of the source, where the landing says so
    (``fetch_month``): a stray row from another month, or one without a time,
    stays with the month it came with.  Else it is the month of the local
    time, and for a row without a time the first requested month (``start``).
    ``start`` / ``end`` (``YYYY-MM``) keep only the requested months.
    ``ingested_at`` defaults to the query start time; ``also`` names further
    columns of ``raw`` to carry along and ``flag`` a column that tells the rows
    of an overlap hour.  ``seen`` observes which raw fields have a value in any
    record, of other months too."""
    df = localize(raw, "measurement_time", tz=tz, ambiguous=ambiguous, flag=flag)
    # a given stamp is a UTC wall clock; turned into an instant zone-independently
    stamp = F.current_timestamp() if ingested_at is None else F.timestamp_micros(
        wall_micros(F.lit(ingested_at.isoformat(sep=" ")).cast("timestamp_ntz")))
    df = df.withColumns({"ingested_at": stamp, **_month_keys(df, tz, start)})
    if seen is not None:
        # also keeps the filter below from being pushed into, and repeating, the localisation
        df = df.observe(seen, *[F.max(F.col(c).isNotNull()).alias(c) for c in RAW_SCHEMA.names])
    ym = F.col("year") * 100 + F.col("month")
    for bound, keep in ((start, lambda v: ym >= v), (end, lambda v: ym <= v)):
        if bound:
            y, m = _ym(bound)
            df = df.filter(keep(y * 100 + m))
    return conform(df, BRONZE_SCHEMA, keep=(*PARTITION_KEYS, *also, *([flag] if flag else [])))


def ingest_months(spark: SparkSession, landing: str | list[str], bronze: str,
                  start: str | None = None, end: str | None = None,
                  tz: str = "Europe/Athens", ambiguous: str = "infer",
                  multiline: bool = False,
                  ingested_at: _dt.datetime | None = None,
                  require_fields: bool = True) -> None:
    """Landing JSON -> bronze, one Spark job for all months of a backfill.
    Only the month partitions that the landing has rows for are replaced; a
    month without any record, like an empty landing, writes nothing and keeps
    what bronze has.

    With ``start`` / ``end`` only those months' landing folders are parsed
    (see ``read_landing``).  The run fails when a declared field occurs in no
    landing record at all (a NULL value is fine); ``require_fields=False``
    loads such a field as NULL.  A run that fails replaces nothing.

    The landing is parsed once.  Which fields have a value is observed in that
    pass, and only those that never have one are looked for again (up to the
    first record with all of them).  Rows of an overlap hour are written
    apart and their offsets told from these alone; ``ambiguous="runs"`` needs
    the other rows' places too and reads the landing's times once more."""
    raw = read_landing(spark, landing, multiline=multiline, start=start, end=end)
    infer = ambiguous == "infer"
    seen = Observation()
    rows = to_bronze(raw, tz, "earlier" if infer else ambiguous, ingested_at, start, end, flag="overlap", seen=seen)
    if not infer:
        rows = rows.withColumn("overlap", F.lit(False))

    def check(found: bool) -> None:
        if require_fields:
            got = seen.get if found else {}
            missing = missing_fields(spark, landing, multiline, start=start, end=end,
                                     among=[c for c in RAW_SCHEMA.names if not got.get(c)])
            if missing:
                raise SchemaMismatch(f"fields missing from every landing record: {missing}")

    replace_in_two_passes(rows, bronze, PARTITION_KEYS, "overlap",
                          lambda overlap: settle_overlap(overlap, tz=tz).select(*overlap.columns),
                          ("measurement_time",), check)


# Superseded records up to this number are told to the tasks by a broadcast
# (about 40 bytes each); more are joined by their hashes.
BROADCAST_RECORDS = 200_000


def _ranked(raw: DataFrame) -> DataFrame:
    """The different records of ``raw`` per file, by their hashes, and whether
    they count (``kept``), see ``superseded``."""
    tested, record = record_hash(TEST_KEY), record_hash()
    has_id = F.col("measurement_id").isNotNull()
    keys = {**{f"test_{k}": F.when(has_id, tested[k]).otherwise(record[k]) for k in tested},
            **{f"record_{k}": record[k] for k in record}}
    test, alike_by = [f"test_{k}" for k in tested], list(keys)
    counts = (raw.select(*[c.alias(k) for k, c in keys.items()], "file", "delivery")
              .groupBy(*alike_by, "file", "delivery").agg(F.count(F.lit(1)).alias("n")))
    alike, counted = Window.partitionBy(*alike_by), F.col("delivery") == F.col("newest")
    # dealt out once for the three windows
    ranked = (counts.repartition(*test).withColumn("first", F.min("delivery").over(alike))
              .withColumn("newest", F.max("first").over(Window.partitionBy(*test)))
              .withColumn("owner", F.max(F.when(counted, F.struct("n", "file"))).over(alike)))
    return ranked.select(*RECORD, "file", F.coalesce(
        counted & F.col("file").eqNullSafe(F.col("owner.file")), F.lit(False)).alias("kept"))


def superseded(raw: DataFrame) -> DataFrame:
    """(record hash, file) of the landing rows that do not count, from rows with
    the columns ``file`` and ``delivery`` (a number that grows with time).

    A test (measurement id, connection, time text, fetch month) counts as the
    newest delivery that brought a record of it not seen before has it: that
    is a correction, while records delivered again as they were change
    nothing.  Records of one delivery that share these four but differ
    otherwise are different records and all count.  A record that several files of its delivery hold alike counts
    as often as the file that holds it most often, so a file dropped twice
    changes nothing and a record repeated within a file stays repeated.  A
    record without an id is its own test.

    Only 128-bit hashes are shuffled, after a count per task; never the
    records themselves."""
    return _ranked(raw).where(~F.col("kept")).drop("kept")


TEST_KEY = ("measurement_id", "connection_id", "measurement_time", FETCH_MONTH)
RECORD = ("record_a", "record_b")


def record_hash(names: Sequence[str] = (*RAW_SCHEMA.names, FETCH_MONTH)) -> dict[str, F.Column]:
    """128-bit hash of (these fields of) a landing record as two numbers ``a``
    and ``b``; nulls are told from empty text, and -0.0 from 0.0."""
    parts = []
    for c in names:
        parts += [F.col(c), F.col(c).isNull()]
        if c in RAW_SCHEMA.names and isinstance(RAW_SCHEMA[c].dataType, T.DoubleType):
            parts.append(F.when(F.col(c) == 0, F.col(c).cast("string")))
    return {"a": F.xxhash64(*parts), "b": F.xxhash64(F.lit("another hash"), *parts)}


@contextmanager
def current_records(spark: SparkSession, read: Callable[[list], DataFrame], files: list,
                    among: Callable[[DataFrame], DataFrame] = lambda raw: raw) -> Iterator[DataFrame]:
    """The landing rows of ``files`` that count, see ``superseded``; ``read``
    gives the rows of some files (with ``file`` and ``delivery``, which are
    dropped), and ``among`` those of them whose tests matter.  The frame is good inside the ``with``.

    Hashes are told by a folder of the scratch root: those of rows that do not
    count; of the others it only says which files have any, and only these are
    read again."""
    told = scratch_path(spark, "superseded")
    try:
        ranked = _ranked(among(read(files)))
        gone = [F.when(~F.col("kept"), F.col(c)).alias(c) for c in RECORD]
        with freed_shuffles(spark):
            ranked.select(*gone, "file", "kept").write.option("compression", "zstd").parquet(told)
        known = spark.read.schema("record_a long, record_b long, file int, kept boolean").parquet(told)
        some = {(r["file"], r["kept"]) for r in known.select("file", "kept").distinct().collect()}     # files, not records
        alive = [f for f in files if (f, True) in some]
        mixed, whole = [f for f in alive if (f, False) in some], [f for f in alive if (f, False) not in some]
        rows = (read(whole) if whole else read(files).where(F.lit(False))).drop("file", "delivery")
        if mixed:
            gone = known.where(~F.col("kept") & F.col("file").isin(mixed)).drop("kept")
            gone = F.broadcast(gone) if gone.count() <= BROADCAST_RECORDS else gone
            hashes = {f"record_{k}": c for k, c in record_hash().items()}
            left = read(mixed).withColumns(hashes).join(gone, [*RECORD, "file"], "left_anti").drop(*RECORD, "file", "delivery")
            rows = rows.unionByName(left) if whole else left        # neither: no record is left of any file
        yield rows
    finally:
        delete(spark, told)


SILVER_CLUSTER = ("measurement_date", "user_id", "connection_regional_unit")
SESSIONS_CLUSTER = ("session_date", "user_id", "behavior_bucket")
FIND_BY = ("user_id",)              # rows are sorted by day first, so statistics can't tell users apart


def write_silver(silver: DataFrame, path: str, months: list[tuple[int, int]] | None = None,
                 granularity: str = "month",
                 clean: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """silver_measurements layout: folders by the bronze month keys when the
    frame has them, and with ``granularity="day"`` below them by
    ``measurement_date``; rows rebalanced on the folder keys and sorted by
    (day, user, regional unit) inside each file.

    Day folders prune day filters at listing time, for tables whose days fill
    files; with month folders Parquet min/max statistics answer them.  With
    ``months`` exactly those months are replaced (one without rows is
    emptied), else the whole table.  ``clean`` makes silver rows of ``silver``
    where that still holds bronze rows: with month folders after the rebalance,
    which then carries addresses and not their digests."""
    if granularity not in ("month", "day"):
        raise ValueError("granularity must be 'month' or 'day'")
    days = ("measurement_date",) if granularity == "day" else ()
    if clean and days:                  # the rebalance needs the day
        silver, clean = clean(silver), None
    parts = tuple(k for k in PARTITION_KEYS if k in silver.columns)
    if months and parts:
        replace_months(silver, path, months, SILVER_CLUSTER, days, FIND_BY, clean)
    else:
        write_table(silver, path, partition_by=(*parts, *days), cluster_by=SILVER_CLUSTER, dynamic=False,
                    find_by=FIND_BY, derive=clean)


def write_sessions(sessions: DataFrame, path: str, granularity: str = "none", dealt: bool = False) -> None:
    """silver_user_sessions layout: sorted by (day, user, bucket) inside each
    file; with ``granularity="day"`` in folders of ``session_date``.  Sessions
    that were just formed lie in partitions by user (``dealt``) and, without
    folders, stay there."""
    if granularity not in ("none", "day"):
        raise ValueError("granularity must be 'none' or 'day'")
    write_table(sessions, path, partition_by=("session_date",) if granularity == "day" else (),
                cluster_by=SESSIONS_CLUSTER, dynamic=False, find_by=FIND_BY, dealt=dealt and granularity == "none")


def write_gold(gold: DataFrame, path: str) -> None:
    """A gold table: its columns as they are, no folders, replaced whole."""
    write_table(gold, path, dynamic=False)


def _month_shift(ym: tuple[int, int], k: int) -> tuple[int, int]:
    n = ym[0] * 12 + ym[1] - 1 + k
    return n // 12, n % 12 + 1


def write_regional(silver: DataFrame, path: str, months: list[tuple[int, int]] | None = None) -> None:
    """gold_regional_metrics from silver.

    With ``months`` (refreshed silver months, given month folders) only days
    that those months' rows can have are computed anew: a day's rows lie in
    the same or a neighbouring local month, so days of months M-1..M+1 come
    from silver months M-2..M+2 (pruned scan).  The table's other days, one
    row per day and region, are read and written back."""
    if not months or not all(k in silver.columns for k in PARTITION_KEYS):
        write_gold(regional_metrics(silver), path)
        return
    spark = silver.sparkSession
    try:
        old = spark.read.parquet(path)
    except AnalysisException:               # no table yet
        write_gold(regional_metrics(silver), path)
        return
    d = F.col("measurement_date")
    days = {_month_shift(b, k) for b in months for k in (-1, 0, 1)}
    source = {_month_shift(g, k) for g in days for k in (-1, 0, 1)}
    inside = _in_months(F.year(d), F.month(d), days)
    fresh = regional_metrics(silver.filter(_in_months(F.col("year"), F.col("month"), source)).filter(inside))
    write_gold(old.filter(~F.coalesce(inside, F.lit(False))).unionByName(fresh), path)


def _built_for(spark: SparkSession, path: str) -> tuple | None:
    """The timeout in seconds and the baseline days that the partials table,
    and with it the sessions, were built for."""
    try:
        row = spark.read.parquet(path).select("timeout_seconds", "baseline_days").first()
    except AnalysisException:               # no table yet, or one without the columns
        return None
    return tuple(row) if row else None


def refresh_sessions(spark: SparkSession, partials: DataFrame, path: str, touched: DataFrame,
                     session_timeout_minutes: float = 30, max_days_between_sessions: float = 14,
                     granularity: str = "none") -> bool:
    """Bring silver_user_sessions up to date where only users of ``touched``
    (user_id, from_sec) changed; False where nothing did.

    Their sessions are formed anew from the last one that may be open
    (``session_cuts``), from partials of these users and of times from the
    earliest cut on, which Parquet statistics of ``bucket`` find; all other
    sessions are carried over as they are."""
    old = spark.read.parquet(path)
    with freed_shuffles(spark):
        cuts = session_cuts(old, touched, session_timeout_minutes).checkpoint()
    least = cuts.agg(F.min("cut_sec")).first()[0]          # one number
    if least is None:
        return False
    timeout = timeout_seconds(session_timeout_minutes)
    late = partials.where(F.col("bucket") >= F.lit(least // timeout))
    fresh = resumed_sessions(late, cuts, session_timeout_minutes, max_days_between_sessions)
    write_sessions(unchanged_sessions(old, cuts).unionByName(fresh), path, granularity, dealt=True)
    return True


def refresh_warehouse(spark: SparkSession, bronze: str, warehouse: str,
                      session_timeout_minutes: float = 30, max_days_between_sessions: float = 14,
                      merge_schema: bool = False, months: list[str] | None = None,
                      silver_by: str = "month", sessions_by: str = "none") -> dict[str, str]:
    """Recompute the five tables.  Returns table name -> path.

    Without ``months`` everything is rebuilt from bronze and every table is
    replaced whole.  With ``months`` (``["YYYY-MM", ...]``, e.g. the months
    just ingested) exactly those silver months are replaced - the bronze scan
    is pruned to their folders, a month without usable rows is emptied - and
    so are their session-bucket partials (``silver_session_buckets``,
    partitioned like silver).  Sessions span months: those of users with tests
    in these months, before or now, are formed anew from the session that may
    be open there (``refresh_sessions``), the others stay.  The partials carry
    the session timeout and baseline days they were built for; other ones
    rebuild partials and sessions.  Session golds are rebuilt from sessions.
    """
    paths = {t: os.path.join(warehouse, t) for t in TABLES}
    partials_path = os.path.join(warehouse, PARTIALS)
    for path in (bronze, partials_path, *paths.values()):       # what an earlier run left half-way
        finish(spark, path)
    bronze_df = read_bronze(spark, bronze, merge_schema)
    keyed = all(k in bronze_df.columns for k in PARTITION_KEYS)
    wanted = [_ym(m) for m in months] if months and keyed else None
    if wanted:
        bronze_df = bronze_df.filter(_in_months(F.col("year"), F.col("month"), wanted))
    write_silver(bronze_df, paths["silver_measurements"], wanted, silver_by, clean_measurements)
    silver = spark.read.schema(clean_measurements(bronze_df).schema).parquet(paths["silver_measurements"])

    built_for = (timeout_seconds(session_timeout_minutes), float(max_days_between_sessions))
    partial = wanted and _built_for(spark, partials_path) == built_for
    changed = _in_months(F.col("year"), F.col("month"), wanted) if partial else F.lit(True)
    keys = PARTITION_KEYS if keyed else ()
    fresh = (bucket_partials(silver.filter(changed), session_timeout_minutes, keys)
             .withColumns({"timeout_seconds": F.lit(built_for[0]), "baseline_days": F.lit(built_for[1])}))
    stored = spark.read.schema(fresh.schema)
    if partial:
        scratch_root(spark)
        # before the months are replaced: users whose tests may go
        with freed_shuffles(spark):
            gone = first_seconds(stored.parquet(partials_path).filter(changed)).checkpoint()
        replace_months(fresh, partials_path, wanted, ("bucket",))
        partials = stored.parquet(partials_path)
        touched = (gone.unionByName(first_seconds(partials.filter(changed)))
                   .groupBy("user_id").agg(F.min("from_sec").alias("from_sec")))
        refresh_sessions(spark, partials, paths["silver_user_sessions"], touched, session_timeout_minutes,
                         max_days_between_sessions, sessions_by)
    else:
        write_table(fresh, partials_path, partition_by=keys, cluster_by=("bucket",), dynamic=False)
        write_sessions(sessions_from_partials(stored.parquet(partials_path), session_timeout_minutes,
                                              max_days_between_sessions), paths["silver_user_sessions"], sessions_by,
                       dealt=True)
    sessions = spark.read.parquet(paths["silver_user_sessions"])

    write_regional(silver, paths["gold_regional_metrics"], wanted)
    write_gold(user_retention(sessions), paths["gold_user_retention"])
    write_gold(frustration_staircase(sessions), paths["gold_frustration_staircase"])
    return paths
