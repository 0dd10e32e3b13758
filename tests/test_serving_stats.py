import datetime as dt
import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkquality.functions.labels import clean_label_col
from linkquality.operators import serving as sv
from linkquality.operators.stats import (bandwidth_expr, correlation_matrix,
                                         exact_quantile, kernel_density)

COLS = "measurement_date date, connection_periphery string, total_tests long, " \
       "avg_downstream_mbps double, avg_upstream_mbps double, p50_downstream_mbps double, " \
       "avg_rtt_msec double, avg_loss_percentage double, avg_jitter_msec double"

LABELS = {"avg_downstream_mbps": "Downstream", "avg_upstream_mbps": "Upstream", "avg_rtt_msec": "Rtt",
          "avg_loss_percentage": "Loss", "avg_jitter_msec": "Jitter", "total_tests": "Tests"}


def gold(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _row(d, region, n, down, up=1.0, rtt=10.0, loss=0.1, jit=1.0):
    return (d, region, n, down, up, down, rtt, loss, jit)


D = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(40)]


def test_filter_switch(spark):
    g = gold(spark, [_row(D[0], "A", 1, 1.0), _row(dt.date(2015, 1, 1), "B", 1, 1.0)])
    assert sv.filter_regional(g, [], 2019, 2020).count() == 2          # no region: no filter
    assert sv.filter_regional(g, ["A", "B"], 2019, 2020).count() == 1
    st = spark.createDataFrame([(dt.date(2015, 1, 1),), (D[0],)], "session_date date")
    assert sv.filter_sessions_gold(st, None, 2019, 2020).count() == 2
    assert sv.filter_sessions_gold(st, ["A"], 2019, 2020).count() == 1


def test_kpis_skip_null_groups(spark):
    g = gold(spark, [_row(D[0], "A", 2, 10.0, up=None), _row(D[1], "A", 6, 20.0, up=4.0)])
    r = sv.kpis(g).first()
    assert r.avg_downstream_mbps == pytest.approx((10 * 2 + 20 * 6) / 8)
    assert r.avg_upstream_mbps == pytest.approx(4.0)
    assert r.total_tests == 8


def test_rolling_mean_matches_centered_pandas(spark):
    rows = [_row(d, "A", 1, float(i * i % 17)) for i, d in enumerate(D)]
    rows += [_row(d, "B", 1, float(i)) for i, d in enumerate(D[:5])]
    out = sv.rolling_mean(gold(spark, rows), "Download").toPandas()
    for region, grp in out.groupby("connection_periphery"):
        grp = grp.sort_values("measurement_date")
        exp = grp["avg_downstream_mbps"].rolling(31, center=True, min_periods=1).mean()
        np.testing.assert_allclose(grp["rolling_mean"].to_numpy(), exp.to_numpy())


def test_rollups(spark):
    st = spark.createDataFrame(
        [(D[0], "1. Single Test", 3, 0.2), (D[1], "1. Single Test", 5, 0.4),
         (D[0], "3. High (4+)", 1, 1.0)],
        "session_date date, behavior_bucket string, total_sessions long, median_loss_pct double")
    got = {r.behavior_bucket: (r.total_sessions, r.mean_median_loss_pct)
           for r in sv.staircase_rollup(st).collect()}
    assert got["1. Single Test"] == (8, pytest.approx(0.3))
    rt = spark.createDataFrame([(D[0], "Returning user", 3), (D[1], "New/Transient user", 1),
                                (D[2], "Returning user", 4)],
                               "session_date date, user_type string, total_sessions long")
    shares = {r.user_type: r.share for r in sv.retention_rollup(rt).collect()}
    assert shares["Returning user"] == pytest.approx(7 / 8) and sum(shares.values()) == pytest.approx(1)


def test_clamp_and_year_bounds(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (700.0,), (42.0,)], "x double")
    assert [r[0] for r in df.select(sv.clamp("x")).collect()] == [None, 0.0, 500.0, 42.0]
    g = gold(spark, [_row(dt.date(2014, 5, 1), "A", 1, 1.0), _row(D[0], "A", 1, 1.0)])
    r = sv.year_bounds(g).first()
    assert (r.min_year, r.max_year, r.default_start_year, r.default_end_year) == (2014, 2020, 2016, 2020)


@pytest.mark.parametrize("data", [
    list(range(1, 11)),
    [5.0] * 50 + [1.0, 2.0, 9.0],                 # one hot value
    [float(x) for x in np.random.default_rng(1).normal(size=3000)],
    [3.0],
])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.8, 1.0])
def test_exact_quantile(spark, data, q):
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,), (float("nan"),)], "x double")
    got = exact_quantile(df, "x", q).first()[0]
    assert got == pytest.approx(float(np.quantile(np.array(data, dtype=float), q)), rel=1e-12)


def test_correlation_matrix(spark):
    rng = np.random.default_rng(7)
    n = 60
    pdf = pd.DataFrame({"avg_downstream_mbps": rng.normal(size=n), "avg_upstream_mbps": rng.normal(size=n),
                        "avg_rtt_msec": rng.normal(size=n), "avg_loss_percentage": np.full(n, 2.0),
                        "avg_jitter_msec": rng.normal(size=n), "total_tests": rng.integers(1, 9, n)})
    pdf.loc[3, "avg_upstream_mbps"] = np.nan
    sdf = spark.createDataFrame(pdf.astype({"total_tests": "int64"}))
    out = {(r.variable_1, r.variable_2): r.correlation for r in correlation_matrix(sdf).collect()}
    ref = pdf.corr()
    assert len(out) == 36
    for a in pdf.columns:
        for b in pdf.columns:
            e = ref.loc[a, b]
            g = out[LABELS[a], LABELS[b]]
            if math.isnan(e):
                assert g is None                          # constant column
            else:
                assert g == pytest.approx(e, abs=1e-12)


def test_clean_label(spark):
    names = ["avg_downstream_mbps", "avg_loss_percentage", "total_tests", "AVG_Rtt_msec"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(clean_label_col("n")).collect()] == ["Downstream", "Loss", "Tests", "Rtt"]


def _kde(xs, grid, h, counts):
    xs = np.asarray(xs, dtype=float)
    z = (grid[:, None] - xs[None, :]) / h
    d = np.exp(-0.5 * z * z).sum(axis=1) / math.sqrt(2 * math.pi) / h / len(xs)
    return d * len(xs) if counts else d


def _default_bw(xs):
    xs = np.asarray(xs, dtype=float)
    sd = xs.std(ddof=1) if len(xs) > 1 else float("nan")
    q1, q3 = np.quantile(xs, [0.25, 0.75])
    m = min(sd, (q3 - q1) / 1.34) if not math.isnan(sd) else (q3 - q1) / 1.34
    v = m if m > 0 else (sd if sd > 0 else (abs(q1) if abs(q1) > 0 else 1.0))
    return 1.06 * v * len(xs) ** -0.2


def test_kernel_density_brute_force(spark):
    rng = np.random.default_rng(3)
    groups = {"A": rng.normal(300, 40, 80), "B": [7.0, 7.0, 7.0], "C": [12.5]}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("A", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    grid = np.array([0.0 + (j / 250) * 900.0 for j in range(250)] + [900.0])
    for pre in (False, True):
        out = kernel_density(df, "x", (0.0, 900.0), 250, group_by=["g"], counts=True,
                             pre_aggregate=pre).toPandas()
        for g, xs in groups.items():
            got = out[out.g == g].sort_values("value")
            np.testing.assert_allclose(got["value"].to_numpy(), grid)
            np.testing.assert_allclose(got["density"].to_numpy(),
                                       _kde(xs, grid, _default_bw(xs), True),
                                       rtol=1e-9, atol=1e-300)
    fixed = kernel_density(df, "x", (0.0, 500.0), 100, bandwidth=1000.0).toPandas().sort_values("value")
    allx = [x for xs in groups.values() for x in xs]
    np.testing.assert_allclose(fixed["density"].to_numpy(),
                               _kde(allx, fixed["value"].to_numpy(), 1000.0, False), rtol=1e-9)
    ungrouped = kernel_density(df, "x", (0.0, 500.0), 10).toPandas().sort_values("value")
    np.testing.assert_allclose(ungrouped["density"].to_numpy(),
                               _kde(allx, ungrouped["value"].to_numpy(), _default_bw(allx), False),
                               rtol=1e-9)


def test_bandwidth_fallbacks(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "n long, sd double, q1 double, q3 double")
    assert df.select(bandwidth_expr(F.col("n"), F.col("sd"), F.col("q1"), F.col("q3"))).first()[0] \
        == pytest.approx(1.06)


def test_dashboard_page(spark):
    from linkquality.plans import catalog as c
    sf = "/root/testdata/sf0.001"
    regional = c.regional(spark, sf)
    from linkquality.operators.gold import frustration_staircase, user_retention
    sess = c.sessions(spark, sf)
    page = sv.dashboard(regional, user_retention(sess), frustration_staircase(sess),
                        regions=["ASIA", "EUROPE"])
    assert set(page) == {"kpis", "rolling_mean", "tests_volume", "correlation", "scatter",
                         "density_upstream", "density_downstream", "staircase", "retention"}
    years = sv.year_bounds(regional).first()
    sub = sv.filter_regional(regional, ["ASIA", "EUROPE"], years.default_start_year,
                             years.default_end_year)
    assert page["kpis"].first().total_tests == sub.agg(F.sum("total_tests")).first()[0]
    assert page["correlation"].count() == 36
    # one year selection for the whole page: the 2024 sessions fall outside 1997-2001
    assert page["retention"].count() == 0
    wide = sv.dashboard(regional, user_retention(sess), frustration_staircase(sess),
                        regions=["ASIA"], years=(1990, 2024))
    assert wide["retention"].agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    assert wide["staircase"].count() >= 1


def test_density_with_counts_integrates_to_group_size(spark):
    rng = np.random.default_rng(11)
    rows = [("A", float(x)) for x in rng.normal(400, 60, 200)] + \
           [("B", float(x)) for x in rng.normal(200, 30, 50)]
    df = spark.createDataFrame(rows, "g string, x double")
    out = kernel_density(df, "x", (-200.0, 1100.0), 1000, group_by=["g"], counts=True).toPandas()
    for g, n in (("A", 200), ("B", 50)):
        d = out[out.g == g].sort_values("value")
        area = np.trapezoid(d["density"].to_numpy(), d["value"].to_numpy())
        assert area == pytest.approx(n, rel=1e-3)


def test_exact_quantile_extreme_range(spark):
    data = [-1e308, -5.0, 0.0, 3.0, 1e308]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    assert exact_quantile(df, "x", 0.5).first()[0] == 0.0
    assert exact_quantile(df, "x", 0.75).first()[0] == 3.0


def test_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert exact_quantile(df, "x", 0.5).collect()[0][0] is None


def test_gap_density_equals_plain_kernel_sum(spark):
    import datetime as dt
    rng = np.random.default_rng(3)
    t0 = dt.datetime(2024, 1, 1)
    gaps = [0, 0, 5] + rng.integers(0, 4_000_000, 80).tolist()
    rows = [(t0 + dt.timedelta(seconds=int(g)), t0) for g in gaps] + [(t0, None)]
    s = spark.createDataFrame(rows, "session_start timestamp, prev_session_end timestamp")
    got = sorted((r.value, r.density) for r in sv.gap_density(s, 0.8, 1000.0, 100).collect())
    hi = float(np.quantile(gaps, 0.8))
    grid = np.array([hi * j / 100 for j in range(101)])
    want = _kde(gaps, grid, 1000.0, False)
    assert [v for v, _ in got] == pytest.approx(grid.tolist())
    assert [d for _, d in got] == pytest.approx(want.tolist(), rel=1e-9, abs=1e-300)
    same = spark.createDataFrame([(t0, t0)] * 3, s.schema)          # every gap and the quantile are zero
    assert {round(r.density, 9) for r in sv.gap_density(same, 0.8).collect()} == {round(1 / math.sqrt(2 * math.pi) / 1000, 9)}
    assert sv.gap_density(s.where("prev_session_end IS NULL")).count() == 0


def test_ungrouped_default_bandwidth(spark):
    x = [1.0, 2.0, 2.5, 4.0, 10.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    q1, q3 = np.quantile(x, [0.25, 0.75])
    h = 1.06 * min(np.std(x, ddof=1), (q3 - q1) / 1.34) * len(x) ** -0.2
    got = sorted((r.value, r.density) for r in kernel_density(df, "x", (0.0, 12.0), 24).collect())
    grid = np.array([v for v, _ in got])
    assert [d for _, d in got] == pytest.approx(_kde(x, grid, h, False).tolist())


def test_brush_narrows_the_density_charts(spark):
    import datetime as dt
    g = gold(spark, [_row(dt.date(2024, 1, d), r, 1, 10.0 * d, up=float(d)) for d in range(1, 9) for r in ("A", "B")])
    none = spark.createDataFrame([], "session_date date, user_type string, total_sessions long")
    steps = spark.createDataFrame([], "session_date date, behavior_bucket string, total_sessions long, median_loss_pct double")
    page = sv.dashboard(g, none, steps, regions=["A", "B"], years=(2024, 2024),
                        brush=((2.0, 6.0), (0.0, 1000.0)), highlight=["A"])
    want = kernel_density(g.where("connection_periphery = 'A' AND avg_upstream_mbps BETWEEN 2 AND 6"),
                          "avg_upstream_mbps", sv.UPSTREAM_EXTENT, sv.DENSITY_STEPS,
                          group_by=["connection_periphery"], counts=True)
    rows = lambda df: sorted((r.connection_periphery, r.value, round(r.density, 12)) for r in df.collect())
    assert rows(page["density_upstream"]) == rows(want)
    assert page["scatter"].count() == 16


def test_dates_as_timestamps(spark):
    import datetime as dt
    df = sv.with_timestamps(spark.createDataFrame([(dt.date(2024, 1, 2), 1)], "d date, n int"))
    assert df.dtypes == [("d", "timestamp_ntz"), ("n", "int")]
    assert df.first()["d"] == dt.datetime(2024, 1, 2)


def test_grouped_quantiles_equal_percentile(spark):
    import random
    from linkquality.operators.stats import grouped_quantiles, value_counts
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), float(rng.choice([rng.randint(0, 9), rng.random()])))
            for _ in range(800)] + [("hot", 1, 5.0)] * 500 + [("one", 1, 3.5), ("none", 1, None), ("none", 1, float("nan"))]
    df = spark.createDataFrame(rows, "k string, j int, v double").repartition(6)
    probs = {"lo": 0.0, "q1": 0.25, "med": 0.5, "q9": 0.9, "hi": 1.0}
    got = grouped_quantiles(value_counts(df, "v", ["k", "j"]), probs, ["k", "j"])
    want = (df.where("v IS NOT NULL AND NOT isnan(v)").groupBy("k", "j")
            .agg(F.count(F.lit(1)).alias("n_values"), *[F.percentile("v", q).alias(n) for n, q in probs.items()]))
    key = lambda r: (str(r[0]), r[1])
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-14)
    assert "percentile" not in got._jdf.queryExecution().toString().lower()


def test_quantile_reads_its_input_once(spark, tmp):
    """The plan of a gap density holds no scan of the sessions any more: the
    counts were written once."""
    from linkquality.operators.serving import gap_density
    from linkquality.plans.inspect import plan_text
    path = os.path.join(tmp, "s")
    rows = [(dt.datetime(2024, 1, d, 12), dt.datetime(2024, 1, d - 1, 12) if d > 1 else None) for d in range(1, 9)]
    spark.createDataFrame(rows, "session_start timestamp, prev_session_end timestamp").write.parquet(path)
    text = plan_text(gap_density(spark.read.parquet(path)))
    assert "parquet" not in text.lower() and "Subquery" not in text
