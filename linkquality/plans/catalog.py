"""Registered queries: one Spark builder per operator of the inventory, and
the DuckDB SQL that must give the same rows on the same parquet tables.

Inputs are the adapters of ``sources.adapters`` (events -> one month of
measurements, lineitem -> seven years).  Serving queries come twice: for a
selection of regions and years, and (``_all``) over the whole gold table.
Doubles are rounded to 6 places on both sides: the engines add in different
orders, so means, correlations and densities differ in the last bits.
"""

from __future__ import annotations

import datetime as _dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..conf import scratch_path
from ..functions.time import default_month_of, localize, month_series, utc_wallclock
from ..operators import serving as sv
from ..operators.gold import frustration_staircase, regional_metrics, user_retention
from ..operators.sessions import (create_user_sessions, flag_sessions, session_stats,
                                  sessions_by_session_window)
from ..operators.silver import clean_measurements
from ..operators.stats import correlation_matrix, kernel_density
from ..sinks import delete
from ..sources.adapters import m_events, m_lineitem
from ..sources.landing import FETCH_MONTH, read_bronze, read_landing
from ..sources.tables import load, read_table
from . import fixtures
from ..streaming.ingest import ingest_new_files
from .jobs import (ingest_months, refresh_warehouse, to_bronze, write_regional, write_sessions,
                   write_silver)

# Selections of the registered serving queries, chosen for the test data
# (regions of the lineitem adapter, its years, the events month).
REGIONS = ("N/A", "ASIA", "EUROPE")
YEARS = (1997, 2001)
SESSION_YEARS = (2024, 2024)
LATER_IDS = 10_000_000_000      # the second autumn's measurements arrive after the first's
SOME_ADDRESSES = ("10.1.7", "10.1.23", "10.1.61", "10.1.100")
BRUSH_REGIONS = ("ASIA", "EUROPE")
BRUSH_X = (10.0, 40.0)
BRUSH_Y = (200.0, 600.0)
UPSTREAM_EXTENT = sv.UPSTREAM_EXTENT
DOWNSTREAM_EXTENT = sv.DOWNSTREAM_EXTENT
DENSITY_STEPS = sv.DENSITY_STEPS
GAP_BANDWIDTH = 1000.0
GAP_STEPS = 100
INGEST_STAMP_1 = _dt.datetime(2024, 1, 1, 0, 0, 0)
INGEST_STAMP_2 = _dt.datetime(2024, 2, 1, 0, 0, 0)
REINGEST_MONTH = "1998-06"
SCAN_YEAR = 1997

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded to ``places`` decimals for comparison with the oracle.

    The value is nudged away from zero by a relative 2**-40 before rounding
    half away from zero (both steps exact IEEE operations, written the same
    way in the oracle SQL).  Means of inputs with few decimals often sit
    exactly on a rounding tie, where the last-bit noise of different
    summation orders would otherwise round the two engines apart.
    """
    scale = float(10 ** places)
    return df.select(*[(F.round(F.col(f.name) * F.lit(1.0 + 2.0 ** -40) * F.lit(scale), 0)
                        / F.lit(scale)).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Instants as their UTC wall clock (``timestamp_ntz``)."""
    return df.withColumns({c: utc_wallclock(c) for c in cols})


# ------------------------------------------------------------ shared inputs

def silver_events(spark, sf):
    return clean_measurements(m_events(spark, sf))


def silver_lineitem(spark, sf):
    return clean_measurements(m_lineitem(spark, sf))


def sessions(spark, sf, **kw):
    return create_user_sessions(silver_events(spark, sf), **kw)


def regional(spark, sf):
    return regional_metrics(silver_lineitem(spark, sf))


def filtered_regional(spark, sf, regions=REGIONS):
    return sv.filter_regional(regional(spark, sf), regions, *YEARS)


def _bronze_lineitem(spark, sf) -> str:
    landing = fixtures.lineitem_landing(spark, sf)
    bronze = scratch_path(spark, "bronze")
    ingest_months(spark, landing, bronze, ingested_at=INGEST_STAMP_1)
    delete(spark, landing)              # this copy is read no more
    return bronze


# ------------------------------------------------------------ Spark side

def q_raw_json_roundtrip(spark, sf):
    landing = fixtures.events_landing(spark, sf)
    return read_landing(spark, landing).drop(FETCH_MONTH)


def q_bronze_typed(spark, sf):
    landing = fixtures.events_landing(spark, sf)
    b = to_bronze(read_landing(spark, landing), ingested_at=INGEST_STAMP_1)
    return _ntz(b, "measurement_time", "ingested_at")


def _autumn_text(spark, sf, with_offset):
    ev = fixtures.autumn_instants(spark, sf)
    return ev.select("measurement_id", fixtures.local_text(F.col("utc_time"), with_offset=with_offset)
                     .alias("measurement_time"), fixtures.arrival(F.col("utc_time")).alias("arrival"))


def q_bronze_localized(spark, sf):
    out = localize(_autumn_text(spark, sf, False), "measurement_time", order_col="arrival")
    return _ntz(out, "measurement_time").drop("arrival")


def q_bronze_two_autumns(spark, sf):
    """Two years' overlap hours, each one run in arrival order."""
    a, b = (fixtures.autumn_instants(spark, sf, begin) for begin in (
        fixtures.EARLIER_AUTUMN_START_UTC, fixtures.AUTUMN_WINDOW_START_UTC))
    late = b.withColumn("measurement_id", F.col("measurement_id") + F.lit(LATER_IDS))
    both = a.unionByName(late).select("measurement_id", fixtures.local_text(F.col("utc_time")).alias("measurement_time"),
                                      fixtures.arrival(F.col("utc_time")).alias("arrival"))
    out = localize(both, "measurement_time", order_col="arrival", ambiguous="runs")
    return _ntz(out, "measurement_time").drop("arrival")


def q_bronze_spring_gap(spark, sf):
    """Wall clocks of a spring night, an hour of which does not exist."""
    walls = fixtures.autumn_instants(spark, sf, fixtures.SPRING_WINDOW_START_LOCAL).select(
        "measurement_id", F.col("utc_time").alias("measurement_time"))
    return _ntz(localize(walls, "measurement_time"), "measurement_time")


def q_bronze_offset_times(spark, sf):
    out = localize(_autumn_text(spark, sf, True), "measurement_time")
    return _ntz(out, "measurement_time").drop("arrival")


def q_bronze_partition_overwrite(spark, sf):
    landing = fixtures.lineitem_landing(spark, sf)
    bronze = scratch_path(spark, "bronze")
    ingest_months(spark, landing, bronze, ingested_at=INGEST_STAMP_1)
    ingest_months(spark, landing, bronze, start=REINGEST_MONTH, end=REINGEST_MONTH,
                  ingested_at=INGEST_STAMP_2)
    b = read_bronze(spark, bronze)
    return b.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(utc_wallclock("ingested_at")).alias("ingested_at"))


def q_bronze_scan(spark, sf):
    b = read_bronze(spark, _bronze_lineitem(spark, sf), merge_schema=True)
    return b.filter(F.col("year") == SCAN_YEAR).select(
        "measurement_id", "measured_downstream_mbps", "year", "month")


def q_month_range(spark, sf):
    li = load(spark, sf, "lineitem")
    b = li.agg(F.min("l_shipdate").alias("s"), F.max("l_shipdate").alias("e"))
    m = b.select(F.explode(month_series(F.to_date("s"), F.to_date("e"))).alias("d"))
    return m.select(F.year("d").alias("year"), F.month("d").alias("month"),
                    F.col("d").alias("first_day"), F.last_day("d").alias("last_day"))


def q_silver_clean(spark, sf):
    return silver_events(spark, sf)


def _lineitem_keys(spark, sf):
    li = m_lineitem(spark, sf)
    return li.withColumns({"year": F.year("measurement_time"), "month": F.month("measurement_time")})


def q_silver_write_read(spark, sf):
    path = scratch_path(spark, "silver")
    write_silver(_lineitem_keys(spark, sf), path, clean=clean_measurements)
    return read_table(spark, path)


def q_silver_write_read_days(spark, sf):
    """Day folders, the month written twice: the second time replaces the first."""
    path = scratch_path(spark, "silver")
    rows = silver_events(spark, sf)
    for _ in range(2):
        write_silver(rows, path, granularity="day")
    return read_table(spark, path).select(*rows.columns)


def q_silver_of_users(spark, sf):
    """Stored silver of a few client addresses; Bloom filters tell the row groups
    that hold their users."""
    users = [F.sha2(F.lit(c), 256) for c in SOME_ADDRESSES]
    return q_silver_write_read(spark, sf).where(F.col("user_id").isin(*users)).select(
        "user_id", "measurement_id", "measurement_date", "measured_downstream_mbps")


def q_serve_silver_projection(spark, sf):
    s = q_silver_write_read(spark, sf)
    return s.select("measured_downstream_mbps", "measured_jitter_msec", "year")


def q_sessions_flags(spark, sf):
    f = flag_sessions(silver_events(spark, sf))
    return f.select("user_id", "measurement_id", "measurement_time", "session_id")


def q_session_stats(spark, sf):
    return session_stats(flag_sessions(silver_events(spark, sf)))


def q_sessions_enriched(spark, sf):
    return sessions(spark, sf)


def q_sessions_enriched_window(spark, sf):
    return sessions_by_session_window(silver_events(spark, sf))


def q_sessions_short_decay(spark, sf):
    return sessions(spark, sf, max_days_between_sessions=0.1)


def q_sessions_write_read(spark, sf):
    path = scratch_path(spark, "sessions")
    write_sessions(sessions(spark, sf), path)
    return read_table(spark, path)


def q_sessions_write_read_days(spark, sf):
    path = scratch_path(spark, "sessions")
    rows = sessions(spark, sf)
    write_sessions(rows, path, granularity="day")
    return read_table(spark, path).select(*rows.columns)


def q_gold_regional_metrics(spark, sf):
    return regional(spark, sf)


def q_gold_user_retention(spark, sf):
    return user_retention(sessions(spark, sf)).orderBy("session_date", "user_type")


def q_gold_frustration_staircase(spark, sf):
    return frustration_staircase(sessions(spark, sf)).orderBy("session_date", "behavior_bucket")


def q_serve_regional(spark, sf):
    return q_gold_write_read(spark, sf).orderBy("measurement_date")


def q_serve_filtered(spark, sf, regions=REGIONS):
    return filtered_regional(spark, sf, regions)


def q_serve_filtered_sessions(spark, sf):
    st = frustration_staircase(sessions(spark, sf))
    return sv.filter_sessions_gold(st, REGIONS, *SESSION_YEARS)


def _rolling(spark, sf, case, regions):
    r = sv.rolling_mean(filtered_regional(spark, sf, regions), case)
    return r.select("measurement_date", "connection_periphery", sv.STREAM_METRIC[case], "rolling_mean")


def q_serve_rolling_download(spark, sf, regions=REGIONS):
    return _rolling(spark, sf, "Download", regions)


def q_serve_rolling_upload(spark, sf, regions=REGIONS):
    return _rolling(spark, sf, "Upload", regions)


def q_serve_kpis(spark, sf, regions=REGIONS):
    return sv.kpis(filtered_regional(spark, sf, regions))


def q_serve_regions(spark, sf):
    return sv.regions(regional(spark, sf))


def q_serve_year_bounds(spark, sf):
    return sv.year_bounds(regional(spark, sf))


def q_serve_tests_volume(spark, sf, regions=REGIONS):
    return sv.tests_volume(filtered_regional(spark, sf, regions))


def q_serve_staircase(spark, sf):
    st = sv.filter_sessions_gold(frustration_staircase(sessions(spark, sf)), REGIONS, *SESSION_YEARS)
    return sv.staircase_rollup(st)


def q_serve_retention(spark, sf):
    rt = sv.filter_sessions_gold(user_retention(sessions(spark, sf)), REGIONS, *SESSION_YEARS)
    return sv.retention_rollup(rt)


def q_serve_session_histogram(spark, sf):
    return sv.session_histogram(sessions(spark, sf))


def q_serve_gap_quantile(spark, sf):
    return sv.gap_quantile(sessions(spark, sf), 0.8)


def q_serve_brush_filter(spark, sf, regions=REGIONS):
    b = sv.brush_filter(filtered_regional(spark, sf, regions), "avg_upstream_mbps", BRUSH_X,
                        "avg_downstream_mbps", BRUSH_Y, BRUSH_REGIONS)
    return b.select("measurement_date", "connection_periphery",
                    "avg_upstream_mbps", "avg_downstream_mbps")


def q_serve_scatter_clamped(spark, sf, regions=REGIONS):
    r = filtered_regional(spark, sf, regions)
    return r.select("measurement_date", "connection_periphery",
                    sv.clamp("avg_rtt_msec").alias("rtt_clamped"),
                    sv.clamp("avg_downstream_mbps").alias("downstream_clamped"),
                    "avg_jitter_msec")


def q_serve_scatter(spark, sf, regions=REGIONS):
    return sv.scatter(filtered_regional(spark, sf, regions), "avg_upstream_mbps", "avg_downstream_mbps")


def q_serve_correlation(spark, sf, regions=REGIONS):
    return correlation_matrix(filtered_regional(spark, sf, regions))


def q_serve_density_upstream(spark, sf, regions=REGIONS):
    return kernel_density(filtered_regional(spark, sf, regions), "avg_upstream_mbps", UPSTREAM_EXTENT,
                          DENSITY_STEPS, group_by=["connection_periphery"], counts=True)


def q_serve_density_downstream(spark, sf, regions=REGIONS):
    return kernel_density(filtered_regional(spark, sf, regions), "avg_downstream_mbps", DOWNSTREAM_EXTENT,
                          DENSITY_STEPS, group_by=["connection_periphery"], counts=True)


def q_serve_density_gap(spark, sf):
    return sv.gap_density(sessions(spark, sf), 0.8, GAP_BANDWIDTH, GAP_STEPS)


def q_serve_density_brushed(spark, sf):
    drawn = sv.brush_filter(regional(spark, sf), "avg_upstream_mbps", BRUSH_X, "avg_downstream_mbps",
                            BRUSH_Y, BRUSH_REGIONS)
    return kernel_density(drawn, "avg_upstream_mbps", UPSTREAM_EXTENT, DENSITY_STEPS,
                          group_by=["connection_periphery"], counts=True)


def q_serve_retention_years(spark, sf):
    gold = user_retention(create_user_sessions(silver_lineitem(spark, sf)))
    return sv.filter_sessions_gold(gold, REGIONS, *YEARS)


def q_serve_timestamps(spark, sf):
    return sv.with_timestamps(regional(spark, sf)).select("measurement_date", "connection_periphery",
                                                          "total_tests")


def q_default_month(spark, sf):
    days = load(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return days.select("day", default_month_of("day", "monthly").alias("monthly"),
                       default_month_of("day", "daily").alias("daily"))


def _month_counts(df):
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


def q_gold_write_read(spark, sf):
    path = scratch_path(spark, "gold")
    write_regional(silver_lineitem(spark, sf), path)
    return read_table(spark, path)


def q_landing_month(spark, sf):
    """One month of a landing laid out by fetch month."""
    bronze = scratch_path(spark, "bronze")
    ingest_months(spark, fixtures.lineitem_landing_by_month(spark, sf), bronze, start=REINGEST_MONTH,
                  end=REINGEST_MONTH, ingested_at=INGEST_STAMP_1)
    return read_bronze(spark, bronze).select("measurement_id", "measured_downstream_mbps", "year", "month")


def q_ingest_empty_month(spark, sf):
    """A month without records writes nothing: bronze keeps what it has."""
    bronze = _bronze_lineitem(spark, sf)
    landing = fixtures.lineitem_landing_by_month(spark, sf)
    ingest_months(spark, landing, bronze, start="2031-01", end="2031-01", ingested_at=INGEST_STAMP_2)
    return read_bronze(spark, bronze).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(utc_wallclock("ingested_at")).alias("ingested_at"))


def q_stream_ingest_many_files(spark, sf):
    """Every month spread over several files, one file a micro-batch."""
    bronze = scratch_path(spark, "bronze")
    ingest_new_files(spark, fixtures.lineitem_landing(spark, sf, files=4), bronze,
                     scratch_path(spark, "seen"), max_files_per_batch=1)
    return _month_counts(read_bronze(spark, bronze))


def _month_speeds(df):
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.sum("measured_downstream_mbps").alias("sum_mbps"))


def _dropped_again(spark, sf, **kw):
    """Bronze after a second run over a landing to which files were added."""
    bronze, seen = scratch_path(spark, "bronze"), scratch_path(spark, "seen")
    landing = fixtures.lineitem_landing(spark, sf, files=4)
    ingest_new_files(spark, landing, bronze, seen)
    fixtures.drop_again(spark, sf, landing, **kw)
    ingest_new_files(spark, landing, bronze, seen)
    return _month_speeds(read_bronze(spark, bronze))


def q_stream_redelivery(spark, sf):
    """All records delivered twice, those with equal ids and different speeds
    spread over files: every record counts once."""
    return _dropped_again(spark, sf)


def q_stream_correction(spark, sf):
    """One month delivered again with other speeds: the newer ones count."""
    return _dropped_again(spark, sf, month=REINGEST_MONTH, more_mbps=1000.0)


def _refreshed(spark, sf, **kw):
    """A warehouse built at another timeout, then one month re-ingested with
    unusable rows only and refreshed."""
    bronze, warehouse = _bronze_lineitem(spark, sf), scratch_path(spark, "warehouse")
    refresh_warehouse(spark, bronze, warehouse, session_timeout_minutes=90)
    ingest_months(spark, fixtures.unusable_month(spark, sf, REINGEST_MONTH), bronze, start=REINGEST_MONTH,
                  end=REINGEST_MONTH, ingested_at=INGEST_STAMP_2)
    return refresh_warehouse(spark, bronze, warehouse, **kw)


def q_refresh_full_replaces(spark, sf):
    paths = _refreshed(spark, sf)
    return read_table(spark, paths["gold_user_retention"])


def q_refresh_incremental_equals_full(spark, sf):
    paths = _refreshed(spark, sf, months=[REINGEST_MONTH])
    return read_table(spark, paths["gold_user_retention"])


def q_refresh_incremental_sessions(spark, sf):
    """Sessions after one month lost its usable rows and only the users who
    had tests in it were looked at again."""
    bronze, warehouse = _bronze_lineitem(spark, sf), scratch_path(spark, "warehouse")
    refresh_warehouse(spark, bronze, warehouse)
    ingest_months(spark, fixtures.unusable_month(spark, sf, REINGEST_MONTH), bronze, start=REINGEST_MONTH,
                  end=REINGEST_MONTH, ingested_at=INGEST_STAMP_2)
    paths = refresh_warehouse(spark, bronze, warehouse, months=[REINGEST_MONTH])
    return read_table(spark, paths["silver_user_sessions"])


def q_refresh_empties_silver_month(spark, sf):
    paths = _refreshed(spark, sf, months=[REINGEST_MONTH])
    return _month_counts(read_table(spark, paths["silver_measurements"]))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
# The same without a selection of regions: nothing is filtered.
WHOLE = ("serve_filtered", "serve_kpis", "serve_tests_volume", "serve_rolling_download",
         "serve_rolling_upload", "serve_scatter", "serve_scatter_clamped", "serve_brush_filter",
         "serve_correlation", "serve_density_upstream", "serve_density_downstream")
QUERIES |= {f"{name}_all": functools.partial(QUERIES[name], regions=None) for name in WHOLE}


def queries() -> dict[str, Query]:
    return {k: (lambda f: (lambda spark, sf: rounded(f(spark, sf))))(f) for k, f in QUERIES.items()}
