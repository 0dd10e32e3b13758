"""Statistics behind the dashboard (A13-A16, F11-F12): exact quantiles,
the Pearson correlation matrix and Gaussian kernel densities."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..conf import scratch_root
from ..functions.labels import clean_label_col

# The gold metrics of the correlation heat map, in chart order.
CORRELATION_COLUMNS = (
    "avg_downstream_mbps",
    "avg_upstream_mbps",
    "avg_rtt_msec",
    "avg_loss_percentage",
    "avg_jitter_msec",
    "total_tests",
)

SQRT_2PI = math.sqrt(2 * math.pi)


def _clean(c: str) -> Column:
    """Double value with NaN treated as missing."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


# ------------------------------------------------------------ quantiles

def value_counts(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys``, ``x``, ``n``, ``block``: how often each value of ``col``
    (NULL / NaN skipped) occurs in each group, written to the shared scratch
    folder in the order of (group, value), in blocks of a task each.

    It is the first level of a rank index: ``grouped_quantiles`` adds the
    running totals of the blocks and orders only the blocks that hold a wanted
    rank.  Any number of quantiles, and a density's sums, read it instead of
    the input.  Rows are counted map-side, so a value or group with a third of
    all rows is one row, and a group with many values lies in many blocks."""
    scratch_root(df.sparkSession)
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col("x")]
    counts = (df.select(*keys, _clean(col).alias("x")).filter(F.col("x").isNotNull())
              .groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n")))
    return (counts.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("block", F.spark_partition_id()).checkpoint())


def grouped_quantiles(counts: DataFrame, probs: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``value_counts`` (without ``keys`` one row, NULL
    where there is no value): its size ``n_values`` and, for each name of
    ``probs``, the exact, linearly interpolated quantile, the definition of
    Spark ``percentile`` and DuckDB ``quantile_cont``.

    No group is buffered: running totals over a group's blocks tell which one
    or two blocks hold a rank, and only those are scanned in order."""
    if not all(0.0 <= q <= 1.0 for q in probs.values()):
        raise ValueError("q must be in [0, 1]")
    group = Window.partitionBy(*keys)
    before = group.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (counts.groupBy(*keys, "block").agg(F.sum("n").alias("m"))
              .withColumns({"before": F.coalesce(F.sum("m").over(before), F.lit(0)),
                            "n_values": F.sum("m").over(group)}))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q")) for name, q in probs.items()])
    held = (totals.withColumn("w", F.explode(wanted))
            .withColumn("pos", (F.col("n_values") - 1) * F.col("w.q"))
            .filter((F.col("before") <= F.ceil("pos")) & (F.col("before") + F.col("m") > F.floor("pos")))
            .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("block").alias("_block"), "before", "pos",
                    "n_values", F.col("w.name").alias("name")))
    same = F.col("block") == F.col("_block")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = Window.partitionBy(*keys, "block", "name").orderBy("x")
    ranked = counts.join(held, same).withColumn("upto", F.col("before") + F.sum("n").over(inside))
    ends = ranked.groupBy(*keys, "name").agg(
        F.min(F.when(F.col("upto") > F.floor("pos"), F.col("x"))).alias("lo"),
        F.min(F.when(F.col("upto") > F.ceil("pos"), F.col("x"))).alias("hi"),
        F.max(F.col("pos") - F.floor("pos")).alias("part"), F.max("n_values").alias("n_values"))
    value = F.when(F.col("hi") == F.col("lo"), F.col("lo")).otherwise(
        F.col("lo") + F.col("part") * (F.col("hi") - F.col("lo")))
    return ends.groupBy(*keys).agg(F.max("n_values").alias("n_values"), *[
        F.max(F.when(F.col("name") == name, value)).alias(name) for name in probs])


def exact_quantile(df: DataFrame, col: str, q: float, alias: str = "quantile") -> DataFrame:
    """One row with the exact ``q``-quantile of ``col`` (see
    ``grouped_quantiles``; NULL when nothing is left)."""
    return grouped_quantiles(value_counts(df, col), {alias: q}).select(alias)


# ------------------------------------------------------------ correlation

def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Long-form matrix ``(variable_1, variable_2, correlation)``
    with cleaned labels, Pearson on pairwise-complete rows; NULL for a
    constant column.

    Each row is turned into one (pair, x, y) triple per unordered pair of
    columns (a fixed fan-out through ``inline``), and one grouped
    aggregation over the pair id computes ``covar_pop`` and the two
    ``stddev_pop``: few aggregation buffers, so the stage stays in
    whole-stage code generation, and partial aggregates per task leave one
    row per pair to shuffle.  The result is mirrored to the full square.
    """
    cols = list(columns)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    clean = {c: _clean(c) for c in cols}
    triples = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                 F.when(clean[cols[j]].isNotNull(), clean[cols[i]]).alias("x"),
                 F.when(clean[cols[i]].isNotNull(), clean[cols[j]]).alias("y"))
        for i, j in pairs])
    long = df.select(F.inline(triples))
    agg = long.groupBy("i", "j").agg(F.try_divide(
        F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("correlation"))
    names = F.array(*[F.lit(c) for c in cols])
    fwd = F.struct(F.col("i").alias("a"), F.col("j").alias("b"), "correlation")
    rev = F.struct(F.col("j").alias("a"), F.col("i").alias("b"), "correlation")
    both = agg.select(F.inline(F.when(F.col("i") == F.col("j"), F.array(fwd))
                               .otherwise(F.array(fwd, rev))))
    return both.select(clean_label_col(F.element_at(names, F.col("a") + 1)).alias("variable_1"),
                       clean_label_col(F.element_at(names, F.col("b") + 1)).alias("variable_2"),
                       "correlation")


# ------------------------------------------------------------ density

def bandwidth_expr(n, sd, q1, q3) -> Column:
    """Default Gaussian bandwidth of the chart library:
    1.06 * v * n^-0.2 with v = min(sd, IQR/1.34), falling back to sd, |q1|, 1
    when the previous choice is zero or missing."""
    m = F.least(sd, (q3 - q1) / 1.34)
    v = (F.when(m > 0, m).when(sd > 0, sd).when(F.abs(q1) > 0, F.abs(q1))
         .otherwise(F.lit(1.0)))
    return 1.06 * v * F.pow(n.cast("double"), -0.2)


def kernel_density(df: DataFrame, col: str, extent: tuple[float, float], steps: int = 250,
                   group_by: Sequence[str] | None = None, bandwidth: float | None = None,
                   counts: bool = False, pre_aggregate: bool = False) -> DataFrame:
    """Gaussian kernel density of ``col`` sampled at ``steps + 1``
    evenly spaced points of ``extent`` (both ends included), per group.

    ``density`` is the probability density, times the group's size when
    ``counts`` is set.  NULL / NaN values are skipped.  The bandwidth is
    ``bandwidth`` or, when None, the library default per group.

    Work: with ``pre_aggregate`` equal values of a group are first combined
    into (value, multiplicity) by a partial + final aggregation, so integer
    or repeated data (session gaps in whole seconds) pays one kernel per
    distinct value, not per row; for continuous values it only adds a
    shuffle, hence off by default.  Every value then meets every grid point
    through ``explode`` of a generated sequence (a fixed fan-out, not a
    join); the weighted sum is combined map-side, so the last shuffle is
    groups x (steps+1) x tasks rows.

    Default bandwidth: the size and ``stddev_samp`` of each group in one
    aggregation, its exact quartiles by ``grouped_quantiles`` from one
    ``value_counts`` index, which the kernel sums then read too; joined on
    the group keys.
    """
    keys = list(group_by or [])
    lo, hi = float(extent[0]), float(extent[1])
    span = hi - lo
    v = df.select(*keys, _clean(col).alias("_x")).filter(F.col("_x").isNotNull())
    if bandwidth is not None:
        w = v.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_w")) if pre_aggregate \
            else v.withColumn("_w", F.lit(1).cast("long"))
        pts = w.withColumn("_h", F.lit(float(bandwidth)))
    else:
        index = value_counts(v, "_x", keys)
        w = index.select(*keys, F.col("x").alias("_x"), F.col("n").alias("_w"))
        spread = v.groupBy(*keys).agg(F.stddev_samp("_x").alias("sd"))
        ends = grouped_quantiles(index, {"q1": 0.25, "q3": 0.75}, keys)
        h = bandwidth_expr(F.col("n_values"), F.col("sd"), F.col("q1"), F.col("q3"))
        if keys:      # one row per group; AQE broadcasts it only when it measures it small
            pts = w.join(ends.join(spread, on=keys).select(*keys, h.alias("_h")), on=keys)
        else:         # one row reaches the driver
            one = spread.crossJoin(ends).select(h.alias("h")).first()
            pts = w.withColumn("_h", F.lit(one["h"] if one else None).cast("double"))

    grid_value = F.when(F.col("_j") == steps, F.lit(hi)).otherwise(
        F.lit(lo) + (F.col("_j") / F.lit(steps)) * F.lit(span))
    pts = pts.select(*keys, "_x", "_w", "_h",
                     F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("_j"))
    z = (grid_value - F.col("_x")) / F.col("_h")
    agg = pts.groupBy(*keys, "_j").agg(
        F.sum(F.col("_w") * F.exp(F.lit(-0.5) * z * z)).alias("_s"),
        F.sum("_w").alias("_n"), F.max("_h").alias("_h"))
    dens = F.col("_s") / F.lit(SQRT_2PI) / F.col("_h") / F.col("_n")
    if counts:
        dens = dens * F.col("_n")
    return agg.select(*keys, grid_value.alias("value"), dens.alias("density"))
