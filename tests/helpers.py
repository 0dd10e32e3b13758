"""Small frame builders for the unit tests."""

import datetime as dt

from pyspark.sql import types as T

MEAS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("measurement_id", T.LongType()),
    T.StructField("measurement_time", T.TimestampNTZType()),
    T.StructField("measured_downstream_mbps", T.DoubleType()),
    T.StructField("measured_upstream_mbps", T.DoubleType()),
    T.StructField("measured_rtt_msec", T.DoubleType()),
    T.StructField("measured_loss_percentage", T.DoubleType()),
    T.StructField("measured_jitter_msec", T.DoubleType()),
])


def ts(s):
    return dt.datetime.fromisoformat(s)


def meas(spark, rows):
    """rows: (user, id, time text, downstream[, loss])"""
    out = []
    for r in rows:
        user, mid, t, down = r[:4]
        loss = r[4] if len(r) > 4 else 0.1
        out.append((user, mid, ts(t), down, 1.0, 2.0, loss, 0.5))
    return spark.createDataFrame(out, MEAS)
