"""Benchmark of the headline operators.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Inputs (the adapters' measurement tables, silver, sessions, gold) are
written once to the scratch folder and not timed; each timed query reads
Parquet and runs one operator end to end into Spark's ``noop`` sink, so the
numbers are scan + operator.  One warm-up, then the median of ``BENCH_RUNS``
runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from linkquality.conf import build_session, scratch_path  # noqa: E402
from linkquality.operators import serving as sv  # noqa: E402
from linkquality.operators.gold import (frustration_staircase, regional_metrics,  # noqa: E402
                                        user_retention)
from linkquality.operators.sessions import create_user_sessions, sessions_by_session_window  # noqa: E402
from linkquality.operators.silver import clean_measurements  # noqa: E402
from linkquality.operators.stats import correlation_matrix, kernel_density  # noqa: E402
from linkquality.plans import fixtures  # noqa: E402
from linkquality.plans.jobs import ingest_months, refresh_warehouse  # noqa: E402
from linkquality.sources.adapters import m_events, m_lineitem  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")}
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="lq-bench-")
    else:
        extra["spark.checkpoint.dir"] = os.environ["SPARK_CHECKPOINT_DIR"]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, extra=extra)
    spark.sparkContext.setCheckpointDir(extra["spark.checkpoint.dir"])

    def put(df, name, **kw):
        p = scratch_path(spark, name)
        df.write.mode("overwrite").parquet(p)
        return spark.read.parquet(p)

    # ---- untimed inputs
    ev = put(m_events(spark, sf_dir), "m-events")
    li = put(m_lineitem(spark, sf_dir), "m-lineitem")
    silver_ev = put(clean_measurements(ev), "silver-events")
    silver_li = put(clean_measurements(li), "silver-lineitem")
    sessions = put(create_user_sessions(silver_ev), "sessions")
    regional = put(regional_metrics(silver_li), "regional")
    landing = fixtures.lineitem_landing(spark, sf_dir)
    bronze = scratch_path(spark, "bronze")
    ingest_months(spark, landing, bronze)
    filtered = sv.filter_regional(regional, ("N/A", "ASIA", "EUROPE"), 1997, 2001)
    warehouse = scratch_path(spark, "wh-incremental")
    refresh_warehouse(spark, bronze, warehouse)           # the state a monthly run starts from

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    from linkquality.operators.gold import frustration_staircase as _st, user_retention as _rt
    retention_t = put(_rt(sessions), "retention")
    staircase_t = put(_st(sessions), "staircase")

    def q_dashboard():
        for frame in sv.dashboard(regional, retention_t, staircase_t,
                                  regions=("N/A", "ASIA", "EUROPE"), years=(1997, 2001)).values():
            noop(frame)

    def q_gap_density():
        noop(sv.gap_density(sessions, 0.8, 1000.0, 100))

    plan = {
        "clean_measurements": lambda: noop(clean_measurements(li)),
        "create_user_sessions_buckets": lambda: noop(create_user_sessions(silver_ev)),
        "create_user_sessions_window": lambda: noop(sessions_by_session_window(silver_ev)),
        "sessions_on_lineitem": lambda: noop(create_user_sessions(silver_li)),
        "regional_metrics": lambda: noop(regional_metrics(silver_li)),
        "user_retention": lambda: noop(user_retention(sessions)),
        "frustration_staircase": lambda: noop(frustration_staircase(sessions)),
        "rolling_mean": lambda: noop(sv.rolling_mean(filtered, "Download")),
        "kpis": lambda: noop(sv.kpis(filtered)),
        "correlation_matrix": lambda: noop(correlation_matrix(filtered)),
        "kernel_density": lambda: noop(kernel_density(filtered, "avg_upstream_mbps", (0.0, 900.0), 250,
                                                      group_by=["connection_periphery"], counts=True)),
        "gap_quantile_density": q_gap_density,
        "dashboard_page": q_dashboard,
        "ingest_months": lambda: ingest_months(spark, landing, scratch_path(spark, "bronze-b")),
        "refresh_warehouse": lambda: refresh_warehouse(spark, bronze, scratch_path(spark, "wh")),
        "refresh_one_month": lambda: refresh_warehouse(spark, bronze, warehouse, months=["1998-06"]),
    }
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    times = {}
    for name, fn in plan.items():
        if only and name not in only:
            continue
        fn()  # warm-up
        ts = []
        for _ in range(runs):
            t = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t)
        times[name] = round(statistics.median(ts), 3)
    name = os.path.basename(sf_dir.rstrip("/"))
    try:
        sf = float(name[2:]) if name.startswith("sf") else name
    except ValueError:
        sf = name
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
