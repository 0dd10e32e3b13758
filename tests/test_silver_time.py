import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from linkquality.functions.time import (default_month, localize, month_bounds, month_range,
                                       utc_wallclock)
from linkquality.operators.silver import clean_measurements


def _frame(spark, rows):
    return spark.createDataFrame(rows, "measurement_time timestamp_ntz, client_ip string, "
                                       "measurement_id long, measured_downstream_mbps double, "
                                       "connection_municipality string, connection_regional_unit string, "
                                       "connection_periphery string")


def test_clean_rules(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [(t, "1.2.3", 1, -1.0, "a", "b", "c"), (t, "1.2.3", 2, 0.0, "NaN", None, "x"),
            (t, None, 3, None, "a", "b", "c"), (t, None, 4, 5.0, "a", "b", "NaN"),
            (None, "1.2.3", 5, 5.0, "a", "b", "c")]
    out = {r["measurement_id"]: r for r in clean_measurements(_frame(spark, rows)).collect()}
    assert sorted(out) == [2, 4]
    assert out[2]["user_id"] == hashlib.sha256(b"1.2.3").hexdigest()
    assert out[4]["user_id"] is None
    assert (out[2]["connection_municipality"], out[2]["connection_regional_unit"]) == ("N/A", "N/A")
    assert out[4]["connection_periphery"] == "N/A"
    assert out[2]["measurement_date"] == dt.date(2024, 1, 1)
    assert "client_ip" not in clean_measurements(_frame(spark, rows)).columns


def _loc(spark, rows, **kw):
    df = spark.createDataFrame(rows, "measurement_id long, measurement_time string")
    out = localize(df, **kw).withColumn("u", utc_wallclock("measurement_time"))
    return [r["u"].isoformat(sep=" ") for r in out.orderBy("measurement_id").collect()]


def test_spring_gap_moves_forward(spark):
    rows = [(1, "2026-03-29 02:59:59"), (2, "2026-03-29 03:30:00"), (3, "2026-03-29 04:00:00")]
    assert _loc(spark, rows) == ["2026-03-29 00:59:59", "2026-03-29 01:00:00",
                                 "2026-03-29 01:00:00"]


AUTUMN = [(1, "2026-10-25 02:30:00"), (2, "2026-10-25 03:10:00"), (3, "2026-10-25 03:50:00"),
          (4, "2026-10-25 03:10:00"), (5, "2026-10-25 03:50:00"), (6, "2026-10-25 04:10:00")]


def test_autumn_overlap_inferred_from_order(spark):
    assert _loc(spark, AUTUMN) == ["2026-10-24 23:30:00", "2026-10-25 00:10:00",
                                   "2026-10-25 00:50:00", "2026-10-25 01:10:00",
                                   "2026-10-25 01:50:00", "2026-10-25 02:10:00"]


def test_autumn_without_backward_step(spark):
    rows = [AUTUMN[0], AUTUMN[1], AUTUMN[2], AUTUMN[5]]
    with pytest.raises(Exception, match="daylight-saving"):
        _loc(spark, rows)
    assert _loc(spark, rows, ambiguous="earlier")[1:3] == ["2026-10-25 00:10:00",
                                                          "2026-10-25 00:50:00"]
    assert _loc(spark, rows, ambiguous="later")[1:3] == ["2026-10-25 01:10:00",
                                                        "2026-10-25 01:50:00"]


def test_offset_text_and_session_zone_independence(spark):
    rows = [(1, "2026-02-05T05:24:55+02:00"), (2, "2026-02-05 05:24:55"),
            (3, "2026-07-05 05:24:55.123456"), (4, "2026-02-05T03:24:55Z")]
    expected = ["2026-02-05 03:24:55", "2026-02-05 03:24:55", "2026-07-05 02:24:55.123456",
                "2026-02-05 03:24:55"]
    assert _loc(spark, rows) == expected
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert _loc(spark, rows) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_month_range(spark):
    got = [(r.year, r.month, r.first_day, r.last_day)
           for r in month_range(spark, "2023-01", "2023-03").orderBy("year", "month").collect()]
    assert got == [(2023, 1, dt.date(2023, 1, 1), dt.date(2023, 1, 31)),
                   (2023, 2, dt.date(2023, 2, 1), dt.date(2023, 2, 28)),
                   (2023, 3, dt.date(2023, 3, 1), dt.date(2023, 3, 31))]
    assert month_range(spark, "2023-04", "2023-03").count() == 0
    assert month_range(spark, "2023-10", "2023-10").first().last_day == dt.date(2023, 10, 31)


def test_default_month():
    assert default_month(dt.date(2023, 10, 15), "daily") == (2023, 10)
    assert default_month(dt.date(2023, 10, 15), "monthly") == (2023, 9)
    assert default_month(dt.date(2024, 1, 3), "monthly") == (2023, 12)


def test_date_in_session_zone_for_instants(spark):
    df = spark.createDataFrame([(1,)], "x int").select(
        F.lit("2024-01-01 23:30:00").cast("timestamp").alias("t"))
    assert df.select(F.to_date("t")).first()[0] == dt.date(2024, 1, 1)


def test_month_bounds(spark):
    df = spark.createDataFrame([(dt.date(2023, 10, 15),), (dt.date(2024, 2, 3),)], "d date")
    got = [tuple(r) for r in df.select(*month_bounds("d")).collect()]
    assert got == [(dt.date(2023, 10, 1), dt.date(2023, 10, 31)),
                   (dt.date(2024, 2, 1), dt.date(2024, 2, 29))]


def test_date_only_text_is_local_midnight(spark):
    rows = [(1, "2023-10-01"), (2, "2023-10-01 00:00:00"), (3, "2023-10-01T00:00:00+03")]
    assert _loc(spark, rows) == ["2023-09-30 21:00:00"] * 3


def test_spring_gap_and_two_transition_dates(spark):
    rows = [(1, "2025-03-30 03:30:00"), (2, "2025-10-26 03:50:00"), (3, "2025-10-26 03:10:00"),
            (4, "2026-10-25 03:40:00"), (5, "2026-10-25 03:45:00"), (6, "2026-10-25 03:05:00"),
            (7, "2026-06-01 12:00:00")]
    assert _loc(spark, rows) == ["2025-03-30 01:00:00", "2025-10-26 00:50:00", "2025-10-26 01:10:00",
                                 "2026-10-25 00:40:00", "2026-10-25 00:45:00", "2026-10-25 01:05:00",
                                 "2026-06-01 09:00:00"]


def test_order_is_kept_across_ranges_of_arrival_numbers(spark):
    ids = [5, 70_000, 200_000, 200_001, 10 ** 9]
    times = ["03:10", "03:50", "03:20", "03:21", "03:59"]
    rows = [(i, f"2026-10-25 {t}:00") for i, t in zip(ids, times)]
    assert _loc(spark, rows) == ["2026-10-25 00:10:00", "2026-10-25 00:50:00", "2026-10-25 01:20:00",
                                 "2026-10-25 01:21:00", "2026-10-25 01:59:00"]


@pytest.mark.parametrize("times", [["03:10", "03:50"], ["03:50", "03:10", "03:40", "03:20"], ["03:30"]])
def test_order_that_tells_nothing_fails(spark, times):
    with pytest.raises(Exception, match="cannot infer"):
        _loc(spark, [(i, f"2026-10-25 {t}:00") for i, t in enumerate(times)])


def test_step_back_without_arrival_number_fails(spark):
    with pytest.raises(Exception, match="cannot infer"):
        _loc(spark, [(None, "2026-10-25 03:10:00"), (None, "2026-10-25 03:10:00"), (1, "2026-10-25 03:40:00")])


def test_first_day_of_a_range_can_be_a_change(spark):
    df = spark.createDataFrame([(1, "2026-11-01 01:50:00"), (2, "2026-11-01 01:10:00")],
                               "measurement_id long, measurement_time string")
    got = localize(df, tz="America/New_York").orderBy("measurement_id")
    assert [str(r[0]) for r in got.select(F.date_format("measurement_time", "HH:mm")).collect()] == ["05:50", "06:10"]


def test_only_overlap_rows_are_shuffled(spark, tmp):
    import os
    from linkquality.plans.inspect import plan_text
    path = os.path.join(tmp, "raw")
    spark.createDataFrame([(1, "2026-02-05 05:24:55", "payload")],
                          "measurement_id long, measurement_time string, payload string").write.parquet(path)
    text = plan_text(localize(spark.read.parquet(path)))
    exchanges = [part for part in text.split("\n\n") if "Exchange" in part.split("\n")[0]]
    assert exchanges and not any("payload" in part for part in exchanges)


def _by_runs(spark, walls, ids=None):
    rows = list(zip(ids or range(len(walls)), walls))
    df = spark.createDataFrame(rows, "measurement_id long, measurement_time string").repartition(3)
    return [r[0] for r in localize(df, ambiguous="runs").orderBy("measurement_id")
            .select(F.unix_micros("measurement_time")).collect()]


def _one_night(rng, day):
    """Wall clocks of a night on which clocks go back, in arrival order."""
    t = sorted(rng.uniform(0, 5) for _ in range(rng.randint(12, 30)))
    return [f"{day} 0{int(x if x < 4 else x - 1)}:{int(x % 1 * 60):02d}:{int(x * 3600 % 60):02d}" for x in t]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_whole_series_inference(spark, monkeypatch, seed):
    """Against one ordered pass over the whole series, with blocks and ranges
    so small that runs span several and gaps leave some empty."""
    import random
    import pandas as pd
    from linkquality.functions import time as lt
    rng = random.Random(seed)
    monkeypatch.setattr(lt, "_ORDER_BLOCK", rng.choice([2, 3, 5]))
    monkeypatch.setattr(lt, "_ORDER_RANGE", rng.choice([1, 2, 3]))
    walls = []
    for day in ("2022-10-30", "2023-10-29", "2024-10-27"):
        walls += _one_night(rng, day)
    if seed % 3 == 1:           # another hour's row within the overlap
        at = next(i for i, w in enumerate(walls) if " 03:" in w)
        walls.insert(at + 2, "2022-10-30 12:00:00")
    if seed % 3 == 2:           # one more step back
        at = max(i for i, w in enumerate(walls) if " 03:" in w)
        walls.insert(at + 1, walls[at])
    ids, n = [], 0
    for _ in walls:
        n += rng.choice([1, 1, 1, 2, 9])
        ids.append(n)
    try:
        want = list(pd.Series(pd.to_datetime(walls)).dt.tz_localize(
            "Europe/Athens", ambiguous="infer", nonexistent="shift_forward").astype("int64"))
    except Exception as e:      # noqa: BLE001 - the class depends on the zone library
        assert "Ambiguous" in type(e).__name__ or "dst" in str(e).lower(), e
        want = None
    if want is None:
        with pytest.raises(Exception, match="cannot infer"):
            _by_runs(spark, walls, ids)
    else:
        unit = max(want) // 10 ** 15
        assert _by_runs(spark, walls, ids) == [w // (1000 if unit > 1000 else 1) for w in want]


def test_runs_by_hand(spark):
    """A lone row or a run that only moves forward can't be told; two runs of
    one date are two runs; rows of other hours split them."""
    for walls in (["2024-10-27 03:10:00"], ["2024-10-27 03:10:00", "2024-10-27 03:20:00"],
                  ["2024-10-27 03:10:00", "2024-10-27 09:00:00", "2024-10-27 03:05:00"]):
        with pytest.raises(Exception, match="cannot infer"):
            _by_runs(spark, walls)
    two = [f"2024-10-27 {x}:00" for x in ("03:10", "03:05", "09:00", "03:50", "03:40")]
    got = _by_runs(spark, two)
    assert [got[1] - got[0], got[4] - got[3]] == [55 * 60 * 10 ** 6, 50 * 60 * 10 ** 6]
    assert _by_runs(spark, ["2024-03-31 03:30:00", "2024-03-31 04:00:00"]) == [1711846800000000] * 2


@pytest.mark.parametrize("key", ["bronze_localized", "bronze_two_autumns"])
def test_ids_out_of_time_order(spark, tmp, key):
    """Ids that don't follow time and tests made at the same moment: the
    arrival, not the id, tells the two passes of the overlap hour."""
    import os
    from linkquality.plans import catalog
    from linkquality.plans.fixtures import AUTUMN_WINDOW_START_UTC, EARLIER_AUTUMN_START_UTC
    start, hours = dt.datetime(2024, 1, 1), [x * 10 + k * 3.7 for x in range(72) for k in (0, 1)]
    rows = [(i, start + dt.timedelta(hours=h), 1, "view", 3.0, "{}") for i, h in enumerate(hours)]
    rows += [(1000 + i, *r[1:]) for i, r in enumerate(reversed(rows))]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                                "props string").write.parquet(os.path.join(tmp, "events.parquet"))
    want = []
    for begin, add in ((AUTUMN_WINDOW_START_UTC, catalog.LATER_IDS * (key == "bronze_two_autumns")),
                       *([(EARLIER_AUTUMN_START_UTC, 0)] * (key == "bronze_two_autumns"))):
        want += [(r[0] + add, dt.datetime.fromisoformat(begin) + (r[1] - start) / 120) for r in rows]
    got = catalog.QUERIES[key](spark, tmp)
    assert sorted(map(tuple, got.select("measurement_id", "measurement_time").collect())) == sorted(want)


def test_rows_that_came_at_once_are_no_step(spark):
    twice = sorted(AUTUMN + AUTUMN)
    want = [x for x in _loc(spark, AUTUMN) for _ in range(2)]
    assert _loc(spark, twice) == want
    assert len(set(_by_runs(spark, [w for _, w in twice], [i for i, _ in twice]))) == len(AUTUMN)
