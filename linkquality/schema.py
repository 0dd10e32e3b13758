"""Declared schemas of the raw landing records and the bronze table, and
``conform`` which enforces one of them on a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

S, D, L = T.StringType(), T.DoubleType(), T.LongType()

# The raw record fields, in the declared bronze order.  The five
# id-like fields (connection_id, postal code and the three geo ids) are typed
# as text.  ``measurement_time`` arrives as text and is localised later.
RAW_FIELDS = [
    ("measurement_time", S),
    ("connection_id", S),
    ("client_ip", S),
    ("measurement_id", L),
    ("measured_downstream_mbps", D),
    ("measured_upstream_mbps", D),
    ("measured_rtt_msec", D),
    ("measured_loss_percentage", D),
    ("measured_jitter_msec", D),
    ("client_operating_system", S),
    ("client_operating_system_version", S),
    ("client_operating_system_architecture", S),
    ("ISP", S),
    ("contract_download_mbps", D),
    ("contract_upload_mbps", D),
    ("connection_postal_code", S),
    ("connection_municipality_id", S),
    ("connection_municipality", S),
    ("connection_regional_unit_id", S),
    ("connection_regional_unit", S),
    ("connection_periphery_id", S),
    ("connection_periphery", S),
]

RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])

# Bronze: the raw fields with a real instant for measurement_time, plus the
# load stamp.  year / month are the partition keys of the folder layout.
BRONZE_SCHEMA = T.StructType(
    [T.StructField(n, T.TimestampType() if n == "measurement_time" else t, True)
     for n, t in RAW_FIELDS]
    + [T.StructField("ingested_at", T.TimestampType(), True)]
)

PARTITION_KEYS = ("year", "month")
# Columns that hold digests as lowercase hex text.
HASHED = ("user_id",)

MEASURES = [
    "measured_downstream_mbps",
    "measured_upstream_mbps",
    "measured_rtt_msec",
    "measured_loss_percentage",
    "measured_jitter_msec",
]

GEO_NAMES = ["connection_municipality", "connection_regional_unit", "connection_periphery"]


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Schema-on-write: select the declared columns in declared order with the
    declared types.

    * a declared column the frame does not have -> ``SchemaMismatch``;
    * a column that is not declared -> dropped (``keep`` names exceptions,
      e.g. partition keys);
    * values are cast with the session's ANSI rules, so text that is not a
      number raises at execution instead of turning into NULL.
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise SchemaMismatch(f"columns missing from input: {missing}")
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    cols += [F.col(k) for k in keep if k in have]
    return df.select(*cols)
