"""Serving queries over the gold tables.

Each function is DataFrame -> DataFrame.  Filters come first so that they
reach the scan (and prune date partitions when the gold table is
partitioned); windows and aggregations run on what is left.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.time import epoch_seconds

# The metric a chart shows for each stream direction.
STREAM_METRIC = {"Download": "avg_downstream_mbps", "Upload": "avg_upstream_mbps"}


def _year_range(col: str, start_year: int, end_year: int):
    """``year(col)`` in [start, end] written as a date range, which reaches
    the scan: it prunes day folders and skips row groups by their statistics."""
    return F.col(col).between(F.lit(_dt.date(int(start_year), 1, 1)),
                              F.lit(_dt.date(int(end_year), 12, 31)))


def filter_regional(df: DataFrame, regions: Sequence[str] | None,
                    start_year: int, end_year: int) -> DataFrame:
    """Regions AND years; with no region selected nothing is filtered
    (the year filter is dropped as well)."""
    if not regions:
        return df
    return df.filter(F.col("connection_periphery").isin(list(regions))
                     & _year_range("measurement_date", start_year, end_year))


def filter_sessions_gold(df: DataFrame, regions: Sequence[str] | None,
                         start_year: int, end_year: int) -> DataFrame:
    """Year filter on a session gold table, switched by the same region
    selection (session tables carry no region)."""
    if not regions:
        return df
    return df.filter(_year_range("session_date", start_year, end_year))


def kpis(df: DataFrame) -> DataFrame:
    """Test-weighted mean downstream / upstream and total tests.

    Groups whose mean is NULL are left out of both the numerator and the
    denominator of that mean (equal to the plain formula when none is NULL).
    """
    def weighted(m):
        w = F.when(F.col(m).isNotNull(), F.col("total_tests"))
        return F.try_divide(F.sum(F.col(m) * w), F.sum(w))
    return df.agg(weighted("avg_downstream_mbps").alias("avg_downstream_mbps"),
                  weighted("avg_upstream_mbps").alias("avg_upstream_mbps"),
                  F.sum("total_tests").alias("total_tests"))


def regions(df: DataFrame) -> DataFrame:
    """The region picker's options."""
    return df.select("connection_periphery").distinct()


def year_bounds(df: DataFrame, date_col: str = "measurement_date", span: int = 4) -> DataFrame:
    """First and last year, and the default slider range (last-4 .. last)."""
    y = F.year(date_col)
    return df.agg(F.min(y).alias("min_year"), F.max(y).alias("max_year")).withColumns({
        "default_start_year": F.col("max_year") - span,
        "default_end_year": F.col("max_year"),
    })


def rolling_mean(df: DataFrame, metric: str = "avg_downstream_mbps",
                 before: int = 15, after: int = 15,
                 group_col: str = "connection_periphery",
                 order_col: str = "measurement_date") -> DataFrame:
    """Centred rolling mean over rows (not days) per region, edges using
    the rows that exist.  ``metric`` may also be ``"Download"``/``"Upload"``
    (P17).  Partitions are regions of a gold table (days x regions rows)."""
    metric = STREAM_METRIC.get(metric, metric)
    w = Window.partitionBy(group_col).orderBy(order_col).rowsBetween(-before, after)
    return df.withColumn("rolling_mean", F.avg(metric).over(w))


def tests_volume(df: DataFrame) -> DataFrame:
    """Tests per day and region."""
    return df.groupBy("measurement_date", "connection_periphery").agg(
        F.sum("total_tests").alias("total_tests"))


def staircase_rollup(df: DataFrame) -> DataFrame:
    """A10: sessions per behaviour bucket and the unweighted mean of the daily
    median loss."""
    return df.groupBy("behavior_bucket").agg(
        F.sum("total_sessions").alias("total_sessions"),
        F.avg("median_loss_pct").alias("mean_median_loss_pct"))


def retention_rollup(df: DataFrame) -> DataFrame:
    """Sessions per user type and their share of all sessions.  The
    share's window runs over the rolled-up rows (one per user type)."""
    r = df.groupBy("user_type").agg(F.sum("total_sessions").alias("total_sessions"))
    return r.withColumn("share", F.try_divide(
        F.col("total_sessions"), F.sum("total_sessions").over(Window.partitionBy())))


def session_histogram(sessions: DataFrame) -> DataFrame:
    """Number of sessions per test count."""
    return sessions.groupBy("test_count").agg(F.count(F.lit(1)).alias("sessions"))


def session_gap_seconds(sessions: DataFrame) -> DataFrame:
    """Seconds between a session's start and the previous session's end."""
    return sessions.select(
        (epoch_seconds("session_start") - epoch_seconds("prev_session_end"))
        .alias("time_since_last_session_seconds"))


def gap_quantile(sessions: DataFrame, q: float = 0.8) -> DataFrame:
    """Exact, linearly interpolated quantile of the session gap."""
    from .stats import exact_quantile
    return exact_quantile(session_gap_seconds(sessions), "time_since_last_session_seconds",
                          q, alias="gap_quantile")


def gap_density(sessions: DataFrame, q: float = 0.8, bandwidth: float = 1000.0,
                steps: int = 100) -> DataFrame:
    """Density of the session gap in seconds, at ``steps + 1`` points of
    ``[0, q-quantile]``, with a fixed bandwidth; no rows without a gap.

    Gaps are whole seconds and repeat a lot, so they are counted once
    (``value_counts``, written to the scratch folder); the quantile, the sums
    and the total read the counts, and only the quantile, one number, reaches
    the driver.  A gap meets only the points at which its kernel is not zero
    in a double (39 bandwidths to either side)."""
    from .stats import SQRT_2PI, grouped_quantiles, value_counts
    counted = value_counts(session_gap_seconds(sessions), "time_since_last_session_seconds")
    top = grouped_quantiles(counted, {"hi": q}).first()
    hi = float(top["hi"]) if top and top["hi"] is not None else 0.0
    x, step, reach = F.col("x"), hi / steps, 39.0 * bandwidth
    if step > 0:
        start = F.floor(F.greatest(F.lit(0.0), (x - reach) / step)).cast("int")
        stop = F.ceil(F.least(F.lit(float(steps)), (x + reach) / step)).cast("int")
    else:
        start, stop = F.lit(0), F.lit(steps)
    value = F.when(F.col("j") == steps, F.lit(hi)).otherwise((F.col("j") / F.lit(steps)) * F.lit(hi))
    near = counted.filter(start <= stop).select("x", "n", F.explode(F.sequence(start, stop)).alias("j"))
    z = (value - x) / F.lit(bandwidth)
    sums = near.groupBy("j").agg(F.sum(F.col("n") * F.exp(F.lit(-0.5) * z * z)).alias("s"))
    total = counted.agg(F.sum("n").alias("n")).filter(F.col("n").isNotNull())     # one row
    grid = total.select("n", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("j"))
    return grid.join(sums, "j", "left").select(
        value.alias("value"),
        (F.coalesce("s", F.lit(0.0)) / F.lit(SQRT_2PI) / F.lit(bandwidth) / F.col("n")).alias("density"))


def brush_filter(df: DataFrame, x: str, x_range: tuple[float, float], y: str,
                 y_range: tuple[float, float], regions: Sequence[str] | None = None,
                 region_col: str = "connection_periphery") -> DataFrame:
    """2-D range selection (inclusive) and optional region selection."""
    cond = F.col(x).between(*x_range) & F.col(y).between(*y_range)
    if regions:
        cond = cond & F.col(region_col).isin(list(regions))
    return df.filter(cond)


def clamp(c: str, lo: float = 0.0, hi: float = 500.0):
    """Value pinned to [lo, hi]; NULL stays NULL."""
    return F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi)))


def scatter(df: DataFrame, x: str, y: str, color: str = "connection_periphery") -> DataFrame:
    """P20: the (x, y, colour) points of a scatter chart."""
    return df.select(x, y, color)


def with_timestamps(df: DataFrame) -> DataFrame:
    """Date columns as midnight timestamps (without zone), the type a
    chart's time axis takes."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
                           if isinstance(f.dataType, T.DateType)})


# The regions the dashboard page preselects.
DEFAULT_REGIONS = ("N/A", "ΑΤΤΙΚΗΣ", "ΚΕΝΤΡΙΚΗΣ ΜΑΚΕΔΟΝΙΑΣ")
# The marginal-density extents and sample count of the scatter page.
UPSTREAM_EXTENT = (0.0, 900.0)
DOWNSTREAM_EXTENT = (0.0, 1100.0)
DENSITY_STEPS = 250


def dashboard(regional: DataFrame, retention: DataFrame, staircase: DataFrame,
              regions: Sequence[str] | None = DEFAULT_REGIONS,
              years: tuple[int, int] | None = None,
              stream: str = "Download",
              brush: tuple[tuple[float, float], tuple[float, float]] | None = None,
              highlight: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Every chart's data for one page view, from the three gold tables.

    ``years`` defaults to the slider's default (last year - 4 .. last year),
    read from ``year_bounds`` (one small aggregate).  ``brush`` (ranges of
    upstream and downstream drawn on the scatter chart) and ``highlight``
    (regions picked in its legend) narrow the density charts beside it.  The
    selections are applied first; each frame is lazy and independent."""
    from .stats import correlation_matrix, kernel_density
    if years is None:
        b = year_bounds(regional).first()
        years = (b["default_start_year"], b["default_end_year"]) \
            if b["max_year"] is not None else (0, 0)
    sub = filter_regional(regional, regions, *years)
    drawn = sub
    if brush or highlight:
        everything = (-math.inf, math.inf)
        x, y = brush or (everything, everything)
        drawn = brush_filter(sub, "avg_upstream_mbps", x, "avg_downstream_mbps", y, highlight)
    st = filter_sessions_gold(staircase, regions, *years)
    rt = filter_sessions_gold(retention, regions, *years)
    return {
        "kpis": kpis(sub),
        "rolling_mean": rolling_mean(sub, stream),
        "tests_volume": tests_volume(sub),
        "correlation": correlation_matrix(sub),
        "scatter": scatter(sub, "avg_upstream_mbps", "avg_downstream_mbps"),
        "density_upstream": kernel_density(drawn, "avg_upstream_mbps", UPSTREAM_EXTENT,
                                           DENSITY_STEPS, group_by=["connection_periphery"],
                                           counts=True),
        "density_downstream": kernel_density(drawn, "avg_downstream_mbps", DOWNSTREAM_EXTENT,
                                             DENSITY_STEPS, group_by=["connection_periphery"],
                                             counts=True),
        "staircase": staircase_rollup(st),
        "retention": retention_rollup(rt),
    }
