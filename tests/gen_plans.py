"""Write docs/PLANS.md: physical plans of the main operators at sf0.01."""
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
from linkquality.conf import build_session
from linkquality.plans.inspect import plan_text
from linkquality.operators.silver import clean_measurements
from linkquality.operators.sessions import create_user_sessions, flag_sessions, sessions_by_session_window
from linkquality.operators.gold import regional_metrics, frustration_staircase
from linkquality.operators import serving as sv
from linkquality.operators.stats import correlation_matrix, kernel_density
from linkquality.sources.adapters import m_events, m_lineitem
from linkquality.functions.time import localize
from linkquality.plans import fixtures


def main():
    ck = tempfile.mkdtemp(prefix="gp-")
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ck})
    sf = "/root/testdata/sf0.01"
    d = tempfile.mkdtemp(prefix="gp-data-")
    def put(df, n):
        p = os.path.join(d, n); df.write.parquet(p); return spark.read.parquet(p)
    ev = put(m_events(spark, sf), "ev"); li = put(m_lineitem(spark, sf), "li")
    silver_ev = put(clean_measurements(ev), "sev"); silver_li = put(clean_measurements(li), "sli")
    regional = put(regional_metrics(silver_li), "reg")
    sessions = put(create_user_sessions(silver_ev), "ses")
    txt = put(fixtures.as_api_records(li).select("measurement_id", "measurement_time"), "txt")
    fr = sv.filter_regional(regional, ("N/A", "ASIA", "EUROPE"), 1997, 2001)
    items = [
     ("clean_measurements (silver)", clean_measurements(li)),
     ("regional_metrics (gold)", regional_metrics(silver_li)),
     ("create_user_sessions, buckets (default)", create_user_sessions(silver_ev)),
     ("sessions_by_session_window", sessions_by_session_window(silver_ev)),
     ("flag_sessions, buckets (row-level ids)", flag_sessions(silver_ev)),
     ("frustration_staircase (gold)", frustration_staircase(sessions)),
     ("rolling_mean after the region/year filter", sv.rolling_mean(fr, "Download")),
     ("correlation_matrix", correlation_matrix(fr)),
     ("kernel_density by region", kernel_density(fr, "avg_upstream_mbps", (0.0, 900.0), 250, group_by=["connection_periphery"], counts=True)),
     ("localize (ambiguous='infer')", localize(txt)),
    ]
    out = ["# Physical plans", "",
           "Snapshot of `explain(\"formatted\")` for the main operators, sf0.01, `local[8]`, AQE on",
           "(initial plans, before runtime re-optimisation). Inputs are Parquet tables written by the",
           "operators before them, as in `refresh_warehouse`. Regenerate with `tests/gen_plans.py`.", ""]
    for title, df in items:
        t = plan_text(df)
        tree = t.split("\n\n\n")[0].replace("== Physical Plan ==\n", "")
        scans = [ln for ln in t.splitlines() if ln.startswith(("PushedFilters", "ReadSchema", "PartitionFilters"))]
        out += [f"## {title}", "", "```", tree.rstrip(), *scans, "```", ""]
    open(os.path.join(ROOT, "docs", "PLANS.md"), "w").write("\n".join(out))
    print("written")


if __name__ == "__main__":
    main()
