import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from linkquality import sinks
from linkquality.plans import jobs
from linkquality.plans.jobs import TABLES, ingest_months, refresh_warehouse, write_sessions, write_silver
from linkquality.schema import BRONZE_SCHEMA, RAW_SCHEMA, SchemaMismatch, conform
from linkquality.sinks import replace_months, write_table
from linkquality.sources.landing import missing_fields, read_bronze, read_landing

# An invented record with every declared field.
SAMPLE = {
    "measurement_time": "2024-03-02 10:00:00", "connection_id": 777,
    "client_ip": "198.51.100", "measurement_id": 1,
    "measured_downstream_mbps": 88.5, "measured_upstream_mbps": 12.25,
    "measured_rtt_msec": 21.0, "measured_loss_percentage": 0.5,
    "measured_jitter_msec": 2.5, "client_operating_system": "TestOS 1",
    "client_operating_system_version": "1", "client_operating_system_architecture": "riscv",
    "ISP": "Example Net", "contract_download_mbps": 100.0, "contract_upload_mbps": 20.0,
    "connection_postal_code": 10001.0, "connection_municipality_id": 5.0,
    "connection_municipality": "Δήμος Α", "connection_regional_unit_id": 6.0,
    "connection_regional_unit": "Ενότητα Β", "connection_periphery_id": 7.0,
    "connection_periphery": "ΠΕΡΙΦΕΡΕΙΑ Γ",
}


def _landing(tmp, records, name="landing"):
    d = os.path.join(tmp, name)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.json"), "w", encoding="utf-8") as f:
        for r in records:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")
    return d


def test_landing_types_and_ids(spark, tmp):
    rec = dict(SAMPLE, measured_upstream_mbps=float("nan"))
    df = read_landing(spark, _landing(tmp, [rec]))
    r = df.first()
    assert df.columns == [f.name for f in RAW_SCHEMA.fields] + ["fetch_month"]
    assert r["connection_id"] == "777"
    assert r["connection_postal_code"] == "10001.0"
    assert r["measured_upstream_mbps"] is None            # NaN token -> NULL
    assert missing_fields(spark, _landing(tmp, [rec])) == []


def test_empty_landing_writes_nothing(spark, tmp):
    land = _landing(tmp, [], "empty")
    bronze = os.path.join(tmp, "bronze")
    ingest_months(spark, land, bronze)
    assert not os.path.exists(bronze) or not any(
        n.startswith("year=") for n in os.listdir(bronze))


def test_conform(spark):
    df = spark.createDataFrame([("1", "2.5", "x")], "a string, b string, extra string")
    from pyspark.sql import types as T
    sch = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    out = conform(df, sch)
    assert out.columns == ["a", "b"] and out.first() == (1, 2.5)
    with pytest.raises(SchemaMismatch):
        conform(df.drop("b"), sch)
    bad = spark.createDataFrame([("1", "abc")], "a string, b string")
    with pytest.raises(Exception):
        conform(bad, sch).collect()


def test_ingest_partition_overwrite_and_roundtrip(spark, tmp):
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=t) for i, t in
            [(1, "2023-09-30 23:59:00"), (2, "2023-10-01 00:30:00"), (3, "2023-10-15 12:00:00")]]
    land = _landing(tmp, recs)
    bronze = os.path.join(tmp, "bronze")
    ingest_months(spark, land, bronze, ingested_at=dt.datetime(2024, 1, 1))
    parts = sorted(n for n in os.listdir(bronze) if n.startswith("year="))
    assert parts == ["year=2023"]
    assert sorted(os.listdir(os.path.join(bronze, "year=2023"))) == ["month=10", "month=9"]
    # re-ingest October only: September untouched
    ingest_months(spark, land, bronze, start="2023-10", end="2023-10",
                  ingested_at=dt.datetime(2024, 2, 1))
    b = read_bronze(spark, bronze)
    assert [f.name for f in b.schema.fields] == [f.name for f in BRONZE_SCHEMA.fields] + ["year", "month"]
    got = {(r.month, r.n, r.s) for r in b.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.date_format(F.col("ingested_at"), "yyyy-MM")).alias("s")).collect()}
    assert got == {(9, 1, "2024-01"), (10, 2, "2024-02")}
    assert b.filter("month = 10").select("connection_id").first()[0] == "777"


def test_refresh_warehouse(spark, tmp):
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=f"2024-03-0{1 + i // 3} 10:{i % 3 * 20:02d}:00",
                 client_ip=f"10.0.{i % 2}") for i in range(9)]
    bronze = os.path.join(tmp, "bronze")
    ingest_months(spark, _landing(tmp, recs), bronze)
    paths = refresh_warehouse(spark, bronze, os.path.join(tmp, "wh"))
    assert set(paths) == set(TABLES)
    s = spark.read.parquet(paths["silver_user_sessions"])
    assert s.agg(F.sum("test_count")).first()[0] == 9
    st = spark.read.parquet(paths["gold_frustration_staircase"])
    rt = spark.read.parquet(paths["gold_user_retention"])
    assert st.agg(F.sum("total_sessions")).first()[0] == rt.agg(
        F.sum("total_sessions")).first()[0] == s.count()


def test_write_table_dynamic_overwrite(spark, tmp):
    p = os.path.join(tmp, "t")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    write_table(a, p, partition_by=["k"], cluster_by=["v"])
    write_table(spark.createDataFrame([(2, "z")], "k int, v string"), p, partition_by=["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(p).collect()) == [(1, "x"), (2, "z")]


def test_streaming_ingest_picks_up_only_new_files(spark, tmp):
    from linkquality.streaming.ingest import ingest_new_files
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    bronze, ck = os.path.join(tmp, "bronze"), os.path.join(tmp, "ck")

    def drop(name, rows):
        with open(os.path.join(land, name), "w", encoding="utf-8") as f:
            for r in rows:
                f.write(json.dumps(r, ensure_ascii=False) + "\n")

    drop("2023-09.json", [dict(SAMPLE, measurement_id=1, measurement_time="2023-09-10 10:00:00")])
    _, m1 = ingest_new_files(spark, land, bronze, ck, ingested_at=dt.datetime(2024, 1, 1))
    drop("2023-10.json", [dict(SAMPLE, measurement_id=i, measurement_time=f"2023-10-1{i} 10:00:00")
                          for i in (2, 3)])
    _, m2 = ingest_new_files(spark, land, bronze, ck, ingested_at=dt.datetime(2024, 2, 1))
    _, m3 = ingest_new_files(spark, land, bronze, ck, ingested_at=dt.datetime(2024, 3, 1))
    assert (m1, m2, m3) == (["2023-09"], ["2023-10"], [])          # nothing new the third time
    b = read_bronze(spark, bronze)
    got = {(r.month, r.n, r.s) for r in b.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.date_format(F.col("ingested_at"), "yyyy-MM")).alias("s")).collect()}
    assert got == {(9, 1, "2024-01"), (10, 2, "2024-02")}


def test_missing_field_fails_by_default(spark, tmp):
    rec = {k: v for k, v in SAMPLE.items() if k != "ISP"}
    land = _landing(tmp, [rec], "nokey")
    with pytest.raises(SchemaMismatch, match="ISP"):
        ingest_months(spark, land, os.path.join(tmp, "b1"))
    ingest_months(spark, land, os.path.join(tmp, "b2"), require_fields=False)      # NULL column
    assert read_bronze(spark, os.path.join(tmp, "b2")).first()["ISP"] is None
    extra = dict(SAMPLE, unexpected_field=1, ISP=None)
    ingest_months(spark, _landing(tmp, [extra], "extra"), os.path.join(tmp, "b3"))  # extra fields are dropped
    assert "unexpected_field" not in read_bronze(spark, os.path.join(tmp, "b3")).columns


def test_missing_fields_in_arrays_and_multiline_files(spark, tmp):
    def land(name, text):
        d = os.path.join(tmp, name)
        os.makedirs(d)
        with open(os.path.join(d, "a.json"), "w", encoding="utf-8") as f:
            f.write(text)
        return d

    less = {k: v for k, v in SAMPLE.items() if k != "ISP"}
    arrays = land("arrays", json.dumps([less, less]) + "\n" + json.dumps([less]) + "\n")
    pretty = land("pretty", json.dumps([less, less], indent=2))
    single = land("single", json.dumps(SAMPLE, indent=2))
    assert missing_fields(spark, arrays) == ["ISP"]
    assert missing_fields(spark, pretty, multiline=True) == ["ISP"]
    assert missing_fields(spark, single, multiline=True) == []
    ingest_months(spark, single, os.path.join(tmp, "b"), multiline=True)
    assert read_bronze(spark, os.path.join(tmp, "b")).count() == 1
    assert read_landing(spark, arrays).count() == 3


def _folders(tmp, by_month, name="landing-months"):
    root = os.path.join(tmp, name)
    for month, recs in by_month.items():
        _landing(root, recs, f"fetch_month={month}")
    return root


def test_stray_and_timeless_rows_stay_with_their_fetch(spark, tmp):
    june = [dict(SAMPLE, measurement_id=i, measurement_time=t) for i, t in
            [(1, "2024-06-10 10:00:00"), (2, "2024-07-01 00:30:00"), (3, None)]]
    july = [dict(SAMPLE, measurement_id=i, measurement_time=f"2024-07-1{i} 10:00:00") for i in (4, 5)]
    land, bronze = _folders(tmp, {"2024-06": june, "2024-07": july}), os.path.join(tmp, "bronze")
    ingest_months(spark, land, bronze)
    ingest_months(spark, land, bronze, start="2024-06", end="2024-06")
    got = sorted((r.month, r.measurement_id) for r in read_bronze(spark, bronze).collect())
    assert got == [(6, 1), (6, 2), (6, 3), (7, 4), (7, 5)]
    # flat landing: a row without a time belongs to the month that is asked for
    flat = _landing(tmp, june[:1] + june[2:], "flat")
    ingest_months(spark, flat, os.path.join(tmp, "b2"), start="2024-06", end="2024-06")
    assert read_bronze(spark, os.path.join(tmp, "b2")).where("month = 6").count() == 2


def test_only_the_asked_month_is_read(spark, tmp):
    land = _folders(tmp, {f"2024-{m:02d}": [dict(SAMPLE, measurement_id=m)] for m in range(1, 13)})
    df = read_landing(spark, land, start="2024-03", end="2024-04")
    assert sorted(r.measurement_id for r in df.collect()) == [3, 4]
    assert len(df.inputFiles()) == 12
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "2024-03" in filters and "2024-04" in filters


def test_empty_month_keeps_bronze(spark, tmp):
    bronze = os.path.join(tmp, "bronze")
    ingest_months(spark, _landing(tmp, [SAMPLE]), bronze)
    ingest_months(spark, _landing(tmp, [], "none"), bronze, start="2024-03", end="2024-03")
    assert read_bronze(spark, bronze).count() == 1


def test_refresh_only_some_silver_months(spark, tmp):
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=t) for i, t in
            [(1, "2023-09-10 10:00:00"), (2, "2023-10-10 10:00:00")]]
    bronze, wh = os.path.join(tmp, "bronze"), os.path.join(tmp, "wh")
    ingest_months(spark, _landing(tmp, recs), bronze)
    paths = refresh_warehouse(spark, bronze, wh)
    sep = os.path.join(paths["silver_measurements"], "year=2023", "month=9")
    before = sorted(os.listdir(sep))
    recs2 = [dict(SAMPLE, measurement_id=i, measurement_time="2023-10-11 10:00:00") for i in (3, 4)]
    ingest_months(spark, _landing(tmp, recs2, "land2"), bronze)       # October replaced
    refresh_warehouse(spark, bronze, wh, months=["2023-10"])
    assert sorted(os.listdir(sep)) == before                          # September untouched
    silver = spark.read.parquet(paths["silver_measurements"])
    assert sorted(r.measurement_id for r in silver.collect()) == [1, 3, 4]
    s = spark.read.parquet(paths["silver_user_sessions"])
    assert s.agg(F.sum("test_count")).first()[0] == 3


def test_stream_of_many_files_loses_nothing(spark, tmp):
    from linkquality.streaming.ingest import ingest_new_files
    land, bronze, ck = (os.path.join(tmp, n) for n in ("land", "bronze", "ck"))
    os.makedirs(land)

    def drop(name, rows):
        with open(os.path.join(land, name), "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)

    for k in range(3):
        drop(f"june-{k}.json", [dict(SAMPLE, measurement_id=10 * k + i, measurement_time=f"2024-06-{10 + k} 10:0{i}:00")
                                for i in range(5)])
    _, months = ingest_new_files(spark, land, bronze, ck, max_files_per_batch=1)
    assert months == ["2024-06"] and read_bronze(spark, bronze).count() == 15
    drop("stray.json", [dict(SAMPLE, measurement_id=99, measurement_time=t) for t in ("2024-06-30 20:00:00",)]
         + [dict(SAMPLE, measurement_id=98, measurement_time="2024-07-01 00:10:00"),
            dict(SAMPLE, measurement_id=0, measurement_time="2024-06-10 10:00:00", ISP="corrected"),
            dict(SAMPLE, measurement_id=1, measurement_time="2024-06-11 11:00:00"),
            dict(SAMPLE, measurement_id=97, measurement_time=None)])
    _, months = ingest_new_files(spark, land, bronze, ck)
    assert months == ["2024-06", "2024-07"]
    got = read_bronze(spark, bronze)
    assert got.where("month = 6").count() == 17 and got.where("month = 7").count() == 1
    assert got.where("measurement_id = 0").collect()[0]["ISP"] == "corrected"
    assert got.where("measurement_time IS NULL").count() == 1
    assert ingest_new_files(spark, land, bronze, ck)[1] == []


def test_redelivered_files_and_equal_ids(spark, tmp, monkeypatch):
    from linkquality.streaming import ingest
    land, bronze, ck = (os.path.join(tmp, n) for n in ("land ing", "bronze", "ck"))
    os.makedirs(land)

    def drop(name, rows):
        with open(os.path.join(land, name), "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in rows)

    def rec(i, mbps, day="2024-06-10", **kw):
        return dict(SAMPLE, measurement_id=i, measurement_time=f"{day} 10:00:00", measured_downstream_mbps=mbps, **kw)

    def speeds(month=6):
        rows = read_bronze(spark, bronze).where(f"month = {month}").collect()
        return sorted((r.measurement_id or -1, r.measured_downstream_mbps) for r in rows)

    # one delivery: equal ids with two speeds over two files, a record repeated in a file, one without an id
    drop("a.json", [rec(1, 1.0), rec(2, 2.0), rec(2, 2.0), rec(None, 9.0)])
    drop("b.json", [rec(1, 5.0), rec(2, 2.0)])
    drop("may.json", [rec(7, 7.0, "2024-05-02")])
    ingest.ingest_new_files(spark, land, bronze, ck, max_files_per_batch=1)
    first = [(-1, 9.0), (1, 1.0), (1, 5.0), (2, 2.0), (2, 2.0)]
    assert speeds() == first and speeds(5) == [(7, 7.0)]
    # the same file again under another name changes nothing, and may's file is not read
    read = []
    real = ingest.read_landing
    monkeypatch.setattr(ingest, "read_landing", lambda spark, path, **kw: read.append(path) or real(spark, path, **kw))
    drop("a again.json", [rec(1, 1.0), rec(2, 2.0), rec(2, 2.0), rec(None, 9.0)])
    assert ingest.ingest_new_files(spark, land, bronze, ck)[1] == ["2024-06"]
    assert sorted(os.path.basename(p) for p in read[0]) == ["a again.json", "a.json", "b.json"]
    assert speeds() == first
    drop("c.json", [rec(1, 1.0), rec(1, 6.0), rec(2, 3.5)])                      # corrections
    ingest.ingest_new_files(spark, land, bronze, ck)
    assert speeds() == [(-1, 9.0), (1, 1.0), (1, 6.0), (2, 3.5)]
    # as many superseded records as are joined, not broadcast
    from linkquality.plans import jobs
    monkeypatch.setattr(jobs, "BROADCAST_RECORDS", 0)
    drop("d.json", [rec(1, 8.0)])
    ingest.ingest_new_files(spark, land, bronze, ck)
    assert speeds() == [(-1, 9.0), (1, 8.0), (2, 3.5)]


def test_only_hashes_of_records_are_shuffled(spark, tmp):
    from linkquality.plans.inspect import plan_text
    from linkquality.plans.jobs import superseded
    from linkquality.sources.landing import read_landing
    path = _landing(tmp, [dict(SAMPLE, measurement_id=i) for i in range(3)])
    raw = read_landing(spark, path, with_file=True).withColumn("delivery", F.lit(1).cast("long"))
    tree = plan_text(superseded(raw)).split("\n\n\n")[1]
    for block in tree.split("\n\n"):
        if "Exchange" in block.split("\n")[0]:
            assert "ISP" not in block and "client_ip" not in block, block


def test_records_are_dealt_out_by_test_once(spark, tmp):
    from linkquality.plans.inspect import plan_text
    from linkquality.plans.jobs import superseded
    from linkquality.sources.landing import read_landing
    raw = read_landing(spark, _landing(tmp, [SAMPLE]), with_file=True).withColumn("delivery", F.lit(1).cast("long"))
    tree = plan_text(superseded(raw)).split("\n\n\n")[1]
    assert sum("Exchange" in block.split("\n")[0] for block in tree.split("\n\n")) == 2


def test_record_hashes_tell_null_empty_and_signs(spark):
    from linkquality.plans.jobs import record_hash
    rows = [(None, "", 0.0), ("", None, 0.0), ("", "", 0.0), (None, None, 0.0), ("", "", -0.0), ("", "", None)]
    df = spark.createDataFrame(rows * 2, "ISP string, client_ip string, measured_rtt_msec double")
    names = ("ISP", "client_ip", "measured_rtt_msec")
    got = df.select(F.struct(*record_hash(names).values()).alias("h")).groupBy("h").count().collect()
    assert [r["count"] for r in got] == [2] * 6
    assert all(r.h[0] != r.h[1] for r in got)


def test_files_that_do_not_count_are_not_read_for_bronze(spark, tmp, monkeypatch):
    """A file dropped twice is hashed, and bronze written from the first one in
    one scan; a run that failed is made good by the next, whose files are a later delivery."""
    from linkquality import sinks
    from linkquality.streaming import ingest
    land, bronze, ck = (os.path.join(tmp, n) for n in ("land", "bronze", "ck"))
    os.makedirs(land)

    def drop(name, ids, day="2024-06-10", mbps=1.0):
        with open(os.path.join(land, name), "w", encoding="utf-8") as f:
            f.writelines(json.dumps(dict(SAMPLE, measurement_id=i, measurement_time=f"{day} 10:00:00",
                                         measured_downstream_mbps=mbps)) + "\n" for i in ids)

    read, plans, save, real = [], [], sinks._save, ingest.read_landing
    monkeypatch.setattr(ingest, "read_landing", lambda spark, path, **kw: read.append(
        sorted(os.path.basename(p) for p in path)) or real(spark, path, **kw))
    monkeypatch.setattr(sinks, "_save", lambda df, *a, **k: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), save(df, *a, **k)))
    drop("a.json", [1, 2])
    drop("july.json", [7], "2024-07-01")
    ingest.ingest_new_files(spark, land, bronze, ck)
    assert plans[0].lower().count(" json") == 1
    drop("again.json", [1, 2])
    assert ingest.ingest_new_files(spark, land, bronze, ck)[1] == ["2024-06"]
    assert read[-2:] == [["a.json", "again.json"], ["a.json"]]
    # a file with another month's records: those are not looked at
    drop("both.json", [1], mbps=5.0)
    drop("both2.json", [2], mbps=6.0)
    with open(os.path.join(land, "both2.json"), "a", encoding="utf-8") as f:
        f.write(json.dumps(dict(SAMPLE, measurement_id=8, measurement_time="2024-08-01 10:00:00")) + "\n")

    def broken(*a, **k):
        raise OSError("no room")
    monkeypatch.setattr(sinks, "_save", broken)
    with pytest.raises(OSError, match="no room"):
        ingest.ingest_new_files(spark, land, bronze, ck)
    assert sorted(r[0] for r in read_bronze(spark, bronze).select("measured_downstream_mbps").collect()) == [1.0] * 3
    monkeypatch.setattr(sinks, "_save", save)
    drop("later.json", [2], mbps=9.0)
    assert ingest.ingest_new_files(spark, land, bronze, ck, max_files_per_batch=1)[1] == ["2024-06", "2024-08"]
    got = {r.measurement_id: r.measured_downstream_mbps for r in read_bronze(spark, bronze).collect()}
    assert got == {1: 5.0, 2: 9.0, 7: 1.0, 8: SAMPLE["measured_downstream_mbps"]}
    drop("late.json", [2], mbps=3.0)
    assert ingest.ingest_new_files(spark, land, bronze, ck)[1] == ["2024-06"]
    got = {r.measurement_id: r.measured_downstream_mbps for r in read_bronze(spark, bronze).collect()}
    assert got == {1: 5.0, 2: 3.0, 7: 1.0, 8: SAMPLE["measured_downstream_mbps"]}
    assert ingest.ingest_new_files(spark, land, bronze, ck)[1] == []


def test_monthly_sessions_read_late_buckets_only(spark, tmp, monkeypatch):
    """The partials of the months before are left out by their statistics,
    and sessions before the cut are carried over."""
    from linkquality.plans import jobs
    from linkquality.plans.inspect import plan_text
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=f"2023-{m:02d}-{d:02d} 10:00:00", client_ip=f"10.0.{i % 4}")
            for i, (m, d) in enumerate((m, d) for m in (8, 9, 10) for d in range(1, 9))]
    bronze, wh = os.path.join(tmp, "bronze"), os.path.join(tmp, "wh")
    ingest_months(spark, _landing(tmp, recs), bronze)
    refresh_warehouse(spark, bronze, wh)
    plans = []
    real = jobs.resumed_sessions
    monkeypatch.setattr(jobs, "resumed_sessions",
                        lambda partials, cuts, *a: plans.append(plan_text(partials)) or real(partials, cuts, *a))
    monkeypatch.setattr(jobs, "sessions_from_partials", None)                 # no full build
    refresh_warehouse(spark, bronze, wh, months=["2023-10"])
    pushed = next(ln for ln in plans[0].splitlines() if ln.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(bucket," in pushed


def test_text_in_numeric_field_fails(spark, tmp):
    bad = dict(SAMPLE, measured_rtt_msec="abc")
    with pytest.raises(Exception):
        ingest_months(spark, _landing(tmp, [bad], "bad"), os.path.join(tmp, "b"))
    # an integer where a double is declared is widened
    ok = dict(SAMPLE, measured_rtt_msec=3)
    assert read_landing(spark, _landing(tmp, [ok], "ok")).first()["measured_rtt_msec"] == 3.0


def test_cli_months_and_run(spark, tmp):
    from linkquality import cli
    day = dt.date(2023, 10, 15)
    assert cli.months_for(cli.parse(["monthly", "--landing", "l", "--bronze", "b"]), day) == \
        ("2023-09", "2023-09")
    assert cli.months_for(cli.parse(["monthly", "2022", "5", "--landing", "l", "--bronze", "b"]),
                          day) == ("2022-05", "2022-05")
    assert cli.months_for(cli.parse(["daily", "--landing", "l", "--bronze", "b"]), day) == \
        ("2023-10", "2023-10")
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=t) for i, t in
            [(1, "2023-01-10 10:00:00"), (2, "2023-02-10 10:00:00"), (3, "2023-04-10 10:00:00")]]
    land, bronze = _landing(tmp, recs), os.path.join(tmp, "bronze")
    cli.main(["backfill", "2023-01", "2023-03", "--landing", land, "--bronze", bronze])
    assert sorted(os.listdir(os.path.join(bronze, "year=2023"))) == ["month=1", "month=2"]
    out = cli.main(["refresh", "--bronze", bronze, "--warehouse", os.path.join(tmp, "wh")])
    assert spark.read.parquet(out["tables"]["silver_user_sessions"]).count() == 2


def test_ingest_and_refresh(spark, tmp):
    from linkquality.streaming.ingest import ingest_and_refresh
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    bronze, ck, wh = (os.path.join(tmp, n) for n in ("bronze", "ck", "wh"))
    with open(os.path.join(land, "a.json"), "w", encoding="utf-8") as f:
        for i, t in [(1, "2023-09-10 10:00:00"), (2, "2023-09-10 10:20:00")]:
            f.write(json.dumps(dict(SAMPLE, measurement_id=i, measurement_time=t)) + "\n")
    assert ingest_and_refresh(spark, land, bronze, ck, wh) == ["2023-09"]
    s = spark.read.parquet(os.path.join(wh, "silver_user_sessions"))
    assert s.count() == 1 and s.first()["test_count"] == 2
    assert ingest_and_refresh(spark, land, bronze, ck, wh) == []


def test_incremental_refresh_equals_full_rebuild(spark, tmp):
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=t, client_ip=f"10.0.{i % 3}")
            for i, t in enumerate(["2023-08-31 23:40:00", "2023-09-01 00:30:00",
                                   "2023-09-15 10:00:00", "2023-09-30 23:50:00",
                                   "2023-10-01 01:10:00", "2023-10-20 12:00:00",
                                   "2023-11-05 08:00:00"])]
    bronze = os.path.join(tmp, "bronze")
    ingest_months(spark, _landing(tmp, recs), bronze)
    wh_inc, wh_full = os.path.join(tmp, "inc"), os.path.join(tmp, "full")
    refresh_warehouse(spark, bronze, wh_inc)
    late = [dict(SAMPLE, measurement_id=100 + i, measurement_time=t, client_ip="10.0.9",
                 measured_downstream_mbps=50.0 + i)
            for i, t in enumerate(["2023-10-01 00:05:00", "2023-10-31 23:30:00"])]
    ingest_months(spark, _landing(tmp, recs + late, "land2"), bronze,
                  start="2023-10", end="2023-10")
    refresh_warehouse(spark, bronze, wh_inc, months=["2023-10"])
    refresh_warehouse(spark, bronze, wh_full)
    for t in TABLES:
        a = spark.read.parquet(os.path.join(wh_inc, t))
        b = spark.read.parquet(os.path.join(wh_full, t))
        assert sorted(a.columns) == sorted(b.columns), t
        a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t


def _same(spark, a, b, tables=TABLES):
    for t in tables:
        x, y = (spark.read.parquet(os.path.join(w, t)) for w in (a, b))
        assert sorted(x.columns) == sorted(y.columns), t
        x, y = x.select(*sorted(x.columns)), y.select(*sorted(y.columns))
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, t


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_refresh_replaces_stale_months_and_timeouts(spark, tmp, mode):
    """A month whose rows all became unusable is emptied, a changed timeout
    rebuilds the partials, whatever the session's overwrite mode is."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        recs = [dict(SAMPLE, measurement_id=i, client_ip=f"10.0.{i % 2}", measurement_time=t) for i, t in
                enumerate(["2024-05-10 10:00:00", "2024-05-10 10:40:00", "2024-06-10 10:00:00", "2024-06-10 10:45:00"])]
        bronze, wh = os.path.join(tmp, "bronze"), os.path.join(tmp, "wh")
        ingest_months(spark, _landing(tmp, recs), bronze)
        refresh_warehouse(spark, bronze, wh)
        bad = [dict(r, measured_downstream_mbps=-1.0) for r in recs[2:]]
        ingest_months(spark, _landing(tmp, bad, "bad"), bronze, start="2024-06", end="2024-06")
        for name, kw in (("inc", dict(months=["2024-06"])), ("again", dict(months=["2024-05"], session_timeout_minutes=60)),
                         ("full", dict(session_timeout_minutes=60))):
            refresh_warehouse(spark, bronze, wh, **kw)
            fresh = os.path.join(tmp, f"fresh-{name}")
            refresh_warehouse(spark, bronze, fresh, kw.get("session_timeout_minutes", 30))
            _same(spark, wh, fresh)
        assert spark.read.parquet(os.path.join(wh, "silver_measurements")).count() == 2
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_day_folders_prune(spark, tmp):
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=f"2024-03-0{1 + i % 3} 10:00:00") for i in range(9)]
    bronze, wh, by_month = (os.path.join(tmp, n) for n in ("bronze", "wh", "wh2"))
    ingest_months(spark, _landing(tmp, recs), bronze)
    refresh_warehouse(spark, bronze, wh, silver_by="day", sessions_by="day")
    refresh_warehouse(spark, bronze, wh, silver_by="day", sessions_by="day", months=["2024-03"])
    refresh_warehouse(spark, bronze, by_month)
    _same(spark, wh, by_month)
    for table, day in (("silver_measurements", "measurement_date"), ("silver_user_sessions", "session_date")):
        df = spark.read.parquet(os.path.join(wh, table)).where(f"{day} = DATE'2024-03-02'")
        assert 0 < df.count() and "2024-03-02" in df._jdf.queryExecution().executedPlan().toString() \
            .split("PartitionFilters")[1].split("]")[0]


def test_gold_has_its_columns_and_no_folders(spark, tmp):
    bronze, wh = os.path.join(tmp, "bronze"), os.path.join(tmp, "wh")
    ingest_months(spark, _landing(tmp, [SAMPLE]), bronze)
    for months in (None, ["2024-03"]):
        paths = refresh_warehouse(spark, bronze, wh, months=months)
        gold = spark.read.parquet(paths["gold_regional_metrics"])
        assert not {"year", "month"} & set(gold.columns) and gold.count() == 1
        assert not [n for n in os.listdir(paths["gold_regional_metrics"]) if "=" in n]


def _visible(path):
    return sorted(n for n in os.listdir(path) if n[0] not in "_.")


def _bad_row(spark):
    """Three good months and a row that fails the job that writes it."""
    df = spark.range(0, 3000, 1, 6).selectExpr("2024 AS year", "cast(id % 3 + 1 AS int) AS month", "id AS v")
    return df.withColumn("v", F.when(F.col("v") == 2999, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))


@pytest.mark.parametrize("how", ["dynamic", "static", "plain", "months"])
def test_failed_write_leaves_the_table(spark, tmp, how):
    p = os.path.join(tmp, "t")
    old = [(2024, 1, -1), (2024, 2, -2), (2023, 7, -3)]
    parts = [] if how == "plain" else ["year", "month"]
    write_table(spark.createDataFrame(old, "year int, month int, v long"), p, partition_by=parts)
    with pytest.raises(Exception, match="broken"):
        if how == "months":
            replace_months(_bad_row(spark), p, [(2024, 1), (2024, 2), (2024, 3)])
        else:
            write_table(_bad_row(spark), p, partition_by=parts, dynamic=how == "dynamic")
    assert sorted(tuple(r) for r in spark.read.parquet(p).select("year", "month", "v").collect()) == sorted(old)
    assert not [n for n in os.listdir(p) if n.startswith(sinks.STAGING)]


@pytest.mark.parametrize("after", [0, 1, 2])
@pytest.mark.parametrize("how", ["dynamic", "static", "plain"])
def test_decided_replacement_is_finished_later(spark, tmp, monkeypatch, how, after):
    """The driver dies after some of the renames; the next write carries on."""
    p = os.path.join(tmp, "t")
    parts = [] if how == "plain" else ["k"]
    write_table(spark.createDataFrame([(1, "old"), (2, "old"), (9, "old")], "k int, v string"), p, partition_by=parts)
    move, done = sinks._move, []

    def dying(spark_, source, target):
        if not source.endswith(".part"):
            if len(done) == after:
                raise KeyboardInterrupt
            done.append(target)
        move(spark_, source, target)

    monkeypatch.setattr(sinks, "_move", dying)
    new = spark.createDataFrame([(1, "new"), (2, "new"), (3, "new")], "k int, v string").repartition(3, "k")
    try:
        write_table(new, p, partition_by=parts, dynamic=how == "dynamic")
    except KeyboardInterrupt:
        assert [n for n in os.listdir(p) if n.startswith(sinks.STAGING)]
    monkeypatch.setattr(sinks, "_move", move)
    sinks.finish(spark, p)
    want = {(1, "new"), (2, "new"), (3, "new")} | ({(9, "old")} if how == "dynamic" else set())
    assert {(r.k, r.v) for r in spark.read.parquet(p).collect()} == want
    assert not [n for n in os.listdir(p) if n.startswith(sinks.STAGING)]


def test_a_table_may_be_read_and_replaced_in_one_go(spark, tmp):
    p = os.path.join(tmp, "t")
    write_table(spark.range(10).toDF("v"), p, dynamic=False)
    write_table(spark.read.parquet(p).selectExpr("v + 1 AS v"), p, dynamic=False)
    assert sorted(r.v for r in spark.read.parquet(p).collect()) == list(range(1, 11))


def test_undecided_files_are_not_read(spark, tmp):
    p = os.path.join(tmp, "t")
    write_table(spark.createDataFrame([(1, "a")], "k int, v string"), p, partition_by=["k"])
    left = os.path.join(p, sinks.STAGING + "dead")
    spark.createDataFrame([(1, "half")], "k int, v string").write.partitionBy("k").parquet(left)
    assert [r.v for r in spark.read.parquet(p).collect()] == ["a"]
    sinks.finish(spark, p)
    assert [r.v for r in spark.read.parquet(p).collect()] == ["a"] and os.path.exists(left)


def test_landing_is_parsed_once(spark, tmp, monkeypatch):
    """All fields seen with values: the landing is not looked at again, and
    the plan that writes bronze scans it once."""
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=f"2024-10-{20 + i % 9} 03:{i % 60:02d}:00")
            for i in range(40)]
    land, bronze = _landing(tmp, recs), os.path.join(tmp, "bronze")
    plans, asked = [], []
    save, missing = sinks._save, jobs.missing_fields
    monkeypatch.setattr(sinks, "_save", lambda df, *a, **k: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), save(df, *a, **k)))
    monkeypatch.setattr(jobs, "missing_fields", lambda *a, **k: (asked.append(k["among"]), missing(*a, **k))[1])
    ingest_months(spark, land, bronze, ambiguous="earlier")
    assert asked == [[]] and len(plans) == 1 and plans[0].lower().count(" json") == 1
    assert read_bronze(spark, bronze).count() == 40


def test_fields_never_with_a_value(spark, tmp):
    """NULL or NaN throughout is a value of its own; no such key is not."""
    bronze = os.path.join(tmp, "bronze")
    recs = [dict(SAMPLE, measurement_id=i, ISP=None, measured_rtt_msec=float("nan")) for i in range(3)]
    ingest_months(spark, _landing(tmp, recs, "null"), bronze)
    assert read_bronze(spark, bronze).where("ISP IS NULL AND measured_rtt_msec IS NULL").count() == 3
    for r in recs:
        del r["ISP"]
    recs[1]["measured_downstream_mbps"] = 99.0
    with pytest.raises(SchemaMismatch, match="ISP"):
        ingest_months(spark, _landing(tmp, recs, "without"), bronze)
    assert read_bronze(spark, bronze).where("measured_downstream_mbps = 99").count() == 0
    assert _visible(bronze) == ["year=2024"]


def test_overlap_hour_of_an_ingest(spark, tmp):
    """Both passes of the autumn hour, in the same files' month as the rest;
    an order that can't tell them apart keeps what bronze has."""
    walls = ["02:50", "03:10", "03:50", "03:05", "03:55", "04:10"]
    recs = [dict(SAMPLE, measurement_id=i, measurement_time=f"2024-10-27 {w}:00") for i, w in enumerate(walls)]
    bronze = os.path.join(tmp, "bronze")
    ingest_months(spark, _landing(tmp, recs, "a"), bronze)
    df = read_bronze(spark, bronze)
    assert df.columns == [*BRONZE_SCHEMA.names, "year", "month"]
    got = [r[0] for r in df.orderBy("measurement_id").selectExpr(
        "date_format(to_utc_timestamp(measurement_time, current_timezone()), 'HH:mm')").collect()]
    assert got == ["23:50", "00:10", "00:50", "01:05", "01:55", "02:10"]
    assert _visible(os.path.join(bronze, "year=2024")) == ["month=10"]
    again = [dict(r, measured_downstream_mbps=1.0) for r in recs[:3]]
    with pytest.raises(Exception, match="cannot infer"):
        ingest_months(spark, _landing(tmp, again, "b"), bronze)
    assert read_bronze(spark, bronze).count() == 6
    ingest_months(spark, _landing(tmp, again, "b"), bronze, ambiguous="later")
    assert [r[0] for r in read_bronze(spark, bronze).orderBy("measurement_id").selectExpr(
        "date_format(to_utc_timestamp(measurement_time, current_timezone()), 'HH:mm')").collect()] \
        == ["23:50", "01:10", "01:50"]


def _scanned(df):
    """Rows that the plan's file scans handed on, after running it."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            rows += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


@pytest.mark.parametrize("table", ["silver", "sessions"])
def test_user_filter_skips_row_groups(spark, tmp, monkeypatch, table):
    """Sorted by day, users lie everywhere: only the Bloom filters tell which
    row groups hold one.  (Where a row group's users are few enough for a
    dictionary, the writer leaves the filter out and the dictionary tells.)"""
    df = spark.range(0, 120_000, 1, 4).selectExpr(
        "sha2(cast(id AS string), 256) AS user_id", "id AS v",
        "date_add(add_months(date'2024-01-01', cast(id div 30000 AS int)), "
        f"cast(id % {28 if table == 'silver' else 1} AS int)) AS measurement_date")
    one = F.col("user_id") == F.sha2(F.lit("54321"), 256)
    rows = {}
    for find_by in (("user_id",), ()):
        monkeypatch.setattr(jobs, "FIND_BY", find_by)
        p = os.path.join(tmp, f"{table}-{len(find_by)}")
        if table == "silver":
            write_silver(df.selectExpr("*", "'x' AS connection_regional_unit", "year(measurement_date) AS year",
                                       "month(measurement_date) AS month"), p)
        else:
            write_sessions(df.withColumnRenamed("measurement_date", "session_date")
                           .withColumn("behavior_bucket", F.lit("b")), p, "day")
        found = spark.read.parquet(p).where(one)
        assert [r.v for r in found.collect()] == [54321]
        rows[find_by] = _scanned(found)
    assert 0 < rows["user_id",] <= 30_000 < rows[()], rows
