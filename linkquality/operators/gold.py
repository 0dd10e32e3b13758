"""Gold tables.

All three are one hash aggregation each (partial map-side, final after a
shuffle on the group keys).  ``percentile_approx`` keeps a mergeable sketch
per group, so no group is ever materialised in one place.  Sorting is left to
the reader (``serving``): a table write does not keep row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# User type labels.
RETURNING = "Returning user"
NEW_OR_TRANSIENT = "New/Transient user"

DEFAULT_ACCURACY = 10000


def _median(col: str, accuracy: int):
    return F.percentile_approx(col, 0.5, accuracy)


def regional_metrics(silver: DataFrame, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """gold_regional_metrics: per (day, region) test count, five means and
    the approximate median downstream speed."""
    return silver.groupBy("measurement_date", "connection_periphery").agg(
        F.count("measurement_id").alias("total_tests"),
        F.avg("measured_downstream_mbps").alias("avg_downstream_mbps"),
        _median("measured_downstream_mbps", accuracy).alias("p50_downstream_mbps"),
        F.avg("measured_upstream_mbps").alias("avg_upstream_mbps"),
        F.avg("measured_rtt_msec").alias("avg_rtt_msec"),
        F.avg("measured_loss_percentage").alias("avg_loss_percentage"),
        F.avg("measured_jitter_msec").alias("avg_jitter_msec"),
    )


def user_type(col: str = "has_valid_baseline"):
    return F.when(F.col(col), RETURNING).otherwise(NEW_OR_TRANSIENT)


def user_retention(sessions: DataFrame) -> DataFrame:
    """gold_user_retention: sessions per (day, user type)."""
    return (sessions.withColumn("user_type", user_type())
            .groupBy("session_date", "user_type")
            .agg(F.count("session_id").alias("total_sessions")))


def frustration_staircase(sessions: DataFrame, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """gold_frustration_staircase: per (day, behaviour bucket) session count
    and approximate medians of the session means."""
    return sessions.groupBy("session_date", "behavior_bucket").agg(
        F.count("session_id").alias("total_sessions"),
        _median("avg_downstream", accuracy).alias("median_downstream_mbps"),
        _median("avg_loss", accuracy).alias("median_loss_pct"),
        _median("avg_jitter", accuracy).alias("median_jitter_ms"),
        _median("avg_rtt", accuracy).alias("median_rtt_ms"),
    )
