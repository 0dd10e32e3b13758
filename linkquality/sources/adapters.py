"""Adapters that give the driver's test tables the shape of raw speed-test
records, so the whole pipeline can run on them.

* ``m_events``   - the ``events`` table as one month of measurements
  (January 2024); users are folded by 8 into shared IPs so that sessions of
  every size occur.  Some downstream speeds become NULL and some region names
  ``'NaN'`` / NULL, so the silver clean-up rules are exercised.
* ``m_lineitem`` - ``lineitem`` joined to its order, customer, nation and
  region: seven years of measurements, region = ``r_name``.

Each adapter has a DuckDB twin (``*_SQL``) used by the correctness oracle;
the two must stay expression-for-expression equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import load


def _s(c):
    return c.cast("string")


def m_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    uid = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        F.col("ts").alias("measurement_time"),
        _s(uid).alias("connection_id"),
        F.concat(F.lit("10.0."), _s(F.expr("user_id div 8"))).alias("client_ip"),
        F.col("event_id").alias("measurement_id"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") - 2.0).alias("measured_downstream_mbps"),
        (F.col("value") / 4.0).alias("measured_upstream_mbps"),
        k.alias("measured_rtt_msec"),
        (k / 100.0).alias("measured_loss_percentage"),
        F.when(F.col("event_type") == "error", F.lit(5.0)).otherwise(F.lit(1.0))
         .alias("measured_jitter_msec"),
        F.concat(F.lit("os"), _s(uid % 3)).alias("client_operating_system"),
        _s(uid % 5).alias("client_operating_system_version"),
        F.lit("x64").alias("client_operating_system_architecture"),
        F.concat(F.lit("isp"), _s(uid % 4)).alias("ISP"),
        ((uid % 3 + 1) * 100).cast("double").alias("contract_download_mbps"),
        ((uid % 3 + 1) * 10).cast("double").alias("contract_upload_mbps"),
        _s(uid % 100 + 10000).alias("connection_postal_code"),
        _s(uid % 40).alias("connection_municipality_id"),
        F.concat(F.lit("m"), _s(uid % 40)).alias("connection_municipality"),
        _s(uid % 10).alias("connection_regional_unit_id"),
        F.concat(F.lit("u"), _s(uid % 10)).alias("connection_regional_unit"),
        _s(F.length("event_type")).alias("connection_periphery_id"),
        F.when(F.col("event_id") % 53 == 0, F.lit("NaN"))
         .when(F.col("event_id") % 59 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("event_type")).alias("connection_periphery"),
    )


M_EVENTS_SQL = """
SELECT
  ts AS measurement_time,
  CAST(user_id AS VARCHAR) AS connection_id,
  concat('10.0.', CAST(user_id // 8 AS VARCHAR)) AS client_ip,
  event_id AS measurement_id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value - 2.0 END AS measured_downstream_mbps,
  value / 4.0 AS measured_upstream_mbps,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS measured_rtt_msec,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS measured_loss_percentage,
  CASE WHEN event_type = 'error' THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END AS measured_jitter_msec,
  concat('os', CAST(user_id % 3 AS VARCHAR)) AS client_operating_system,
  CAST(user_id % 5 AS VARCHAR) AS client_operating_system_version,
  'x64' AS client_operating_system_architecture,
  concat('isp', CAST(user_id % 4 AS VARCHAR)) AS ISP,
  CAST((user_id % 3 + 1) * 100 AS DOUBLE) AS contract_download_mbps,
  CAST((user_id % 3 + 1) * 10 AS DOUBLE) AS contract_upload_mbps,
  CAST(user_id % 100 + 10000 AS VARCHAR) AS connection_postal_code,
  CAST(user_id % 40 AS VARCHAR) AS connection_municipality_id,
  concat('m', CAST(user_id % 40 AS VARCHAR)) AS connection_municipality,
  CAST(user_id % 10 AS VARCHAR) AS connection_regional_unit_id,
  concat('u', CAST(user_id % 10 AS VARCHAR)) AS connection_regional_unit,
  CAST(length(event_type) AS VARCHAR) AS connection_periphery_id,
  CASE WHEN event_id % 53 = 0 THEN 'NaN' WHEN event_id % 59 = 0 THEN NULL
       ELSE event_type END AS connection_periphery
FROM events
"""


def m_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    od = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation (25 rows) and region (5 rows) are fixed-size dimension tables of
    # the schema, so broadcasting them is bounded whatever the scale factor;
    # orders and customer grow with it and are left to the planner / AQE.
    na = F.broadcast(load(spark, sf_dir, "nation"))
    rg = F.broadcast(load(spark, sf_dir, "region"))
    # The narrow tables are put together first, so lineitem is shuffled once.
    od = (od.join(cu, od.o_custkey == cu.c_custkey)
            .join(na, F.col("c_nationkey") == na.n_nationkey)
            .join(rg, F.col("n_regionkey") == rg.r_regionkey))
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    ck = F.col("c_custkey")
    return j.select(
        F.col("l_shipdate").alias("measurement_time"),
        _s(ck).alias("connection_id"),
        F.concat(F.lit("10.1."), _s(ck)).alias("client_ip"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("measurement_id"),
        (F.col("l_extendedprice") / 100.0).alias("measured_downstream_mbps"),
        F.col("l_quantity").alias("measured_upstream_mbps"),
        (F.col("l_discount") * 1000.0).alias("measured_rtt_msec"),
        (F.col("l_tax") * 100.0).alias("measured_loss_percentage"),
        (F.col("l_quantity") / 10.0).alias("measured_jitter_msec"),
        F.col("l_returnflag").alias("client_operating_system"),
        F.col("l_linestatus").alias("client_operating_system_version"),
        F.lit("x64").alias("client_operating_system_architecture"),
        F.concat(F.lit("isp"), _s(ck % 7)).alias("ISP"),
        ((ck % 3 + 1) * 100).cast("double").alias("contract_download_mbps"),
        ((ck % 3 + 1) * 10).cast("double").alias("contract_upload_mbps"),
        _s(ck % 1000 + 10000).alias("connection_postal_code"),
        _s(F.col("c_nationkey")).alias("connection_municipality_id"),
        F.col("c_mktsegment").alias("connection_municipality"),
        _s(F.col("n_nationkey")).alias("connection_regional_unit_id"),
        F.col("n_name").alias("connection_regional_unit"),
        _s(F.col("r_regionkey")).alias("connection_periphery_id"),
        F.col("r_name").alias("connection_periphery"),
    )


M_LINEITEM_SQL = """
SELECT
  l_shipdate AS measurement_time,
  CAST(c_custkey AS VARCHAR) AS connection_id,
  concat('10.1.', CAST(c_custkey AS VARCHAR)) AS client_ip,
  l_orderkey * 10 + l_linenumber AS measurement_id,
  l_extendedprice / 100.0 AS measured_downstream_mbps,
  l_quantity AS measured_upstream_mbps,
  l_discount * 1000.0 AS measured_rtt_msec,
  l_tax * 100.0 AS measured_loss_percentage,
  l_quantity / 10.0 AS measured_jitter_msec,
  l_returnflag AS client_operating_system,
  l_linestatus AS client_operating_system_version,
  'x64' AS client_operating_system_architecture,
  concat('isp', CAST(c_custkey % 7 AS VARCHAR)) AS ISP,
  CAST((c_custkey % 3 + 1) * 100 AS DOUBLE) AS contract_download_mbps,
  CAST((c_custkey % 3 + 1) * 10 AS DOUBLE) AS contract_upload_mbps,
  CAST(c_custkey % 1000 + 10000 AS VARCHAR) AS connection_postal_code,
  CAST(c_nationkey AS VARCHAR) AS connection_municipality_id,
  c_mktsegment AS connection_municipality,
  CAST(n_nationkey AS VARCHAR) AS connection_regional_unit_id,
  n_name AS connection_regional_unit,
  CAST(r_regionkey AS VARCHAR) AS connection_periphery_id,
  r_name AS connection_periphery
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""
