"""What larger tables leave on disk: landing files, shuffles, digests."""

import gzip
import hashlib
import os
import time

from conftest import SF001
from pyspark.sql import functions as F

from linkquality import sinks
from linkquality.operators.silver import clean_measurements
from linkquality.plans import catalog, fixtures
from linkquality.plans.inspect import plan_text
from linkquality.plans.jobs import write_silver
from linkquality.sources.adapters import m_lineitem


def _records_per_file(landing):
    files = [os.path.join(d, n) for d, _, names in os.walk(landing) for n in names if n.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    return [sum(1 for _ in gzip.open(f)) for f in files]


def test_landing_files_are_compressed_and_bounded(spark, monkeypatch):
    rows = spark.read.parquet(SF001 + "/lineitem.parquet").count()
    monkeypatch.setattr(fixtures, "FILE_RECORDS", 500)
    for landing in (fixtures.lineitem_landing(spark, SF001), fixtures.lineitem_landing(spark, SF001, files=4),
                    fixtures.lineitem_landing_by_month(spark, SF001)):
        n = _records_per_file(landing)
        assert sum(n) == rows and max(n) <= 500
    monkeypatch.setattr(fixtures, "FILE_RECORDS", 10 ** 6)
    assert len(_records_per_file(fixtures.lineitem_landing(spark, SF001, files=4))) == 4


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_writes_leave_no_shuffle_files(spark, tmp):
    before = _shuffle_files(spark)
    asked = spark.conf.get(sinks.FREE_SHUFFLES, None)
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    sinks.write_table(rows, os.path.join(tmp, "t"), partition_by=("k",), cluster_by=("id",))
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(sinks.FREE_SHUFFLES, None) == asked
    assert spark.read.parquet(os.path.join(tmp, "t")).count() == 1000


def test_any_user_text_survives_the_write(spark, tmp):
    users = [hashlib.sha256(b"a").hexdigest(), "u1", "AB", "Ab", "ab", "abc", "", "00", " ab", "ab\n", "é", None]
    rows = spark.createDataFrame(list(enumerate(users)), "n int, user_id string").select("user_id", "n")
    path = os.path.join(tmp, "t")
    sinks.write_table(rows, path, cluster_by=("user_id",), find_by=("user_id",))
    back = spark.read.parquet(path)
    assert back.columns == rows.columns
    assert [r["user_id"] for r in back.orderBy("n").collect()] == users


def test_silver_is_cleaned_behind_the_rebalance(spark, tmp, monkeypatch):
    rows = catalog._lineitem_keys(spark, SF001)
    path, plans, real = os.path.join(tmp, "silver"), [], type(rows).sortWithinPartitions
    monkeypatch.setattr(type(rows), "sortWithinPartitions",
                        lambda self, *a, **kw: plans.append(plan_text(out := real(self, *a, **kw))) or out)
    write_silver(rows, path, clean=clean_measurements)
    monkeypatch.undo()
    dealt = [part for part in plans[0].split("\n\n") if "REBALANCE" in part]
    assert dealt and all("client_ip" in part and "user_id" not in part for part in dealt)
    want = clean_measurements(rows)
    got = spark.read.schema(want.schema).parquet(path).select(*want.columns)
    assert got.count() == want.count() and not got.exceptAll(want).count()


def test_lineitem_is_shuffled_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(m_lineitem(spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = [part for part in text.split("\n\n") if "Exchange" in part.split("\n")[0]]
    assert sum("l_extendedprice" in part for part in exchanges) == 1


def test_sessions_just_formed_are_not_dealt_again(spark, tmp, monkeypatch):
    """A refresh, whole or of a month, sorts sessions in the partitions that the window or join left."""
    from linkquality.plans import jobs
    bronze, warehouse = catalog._bronze_lineitem(spark, SF001), os.path.join(tmp, "wh")
    plans, real = {}, sinks._save

    def save(df, path, *a, **k):
        plans.setdefault(os.path.basename(os.path.dirname(path)), []).append(k.get("dealt", a[-1] if a else None))
        real(df, path, *a, **k)
    monkeypatch.setattr(sinks, "_save", save)
    paths = jobs.refresh_warehouse(spark, bronze, warehouse)
    whole = spark.read.parquet(paths["silver_user_sessions"])
    want = sorted(map(str, whole.collect()))
    jobs.refresh_warehouse(spark, bronze, warehouse, months=["1998-06"])
    assert plans["silver_user_sessions"] == [True, True]
    assert sorted(map(str, spark.read.parquet(paths["silver_user_sessions"]).collect())) == want


def test_months_refresh_leaves_no_shuffle_files(spark, tmp, monkeypatch):
    from linkquality.plans import jobs
    bronze, warehouse = catalog._bronze_lineitem(spark, SF001), os.path.join(tmp, "wh")
    jobs.refresh_warehouse(spark, bronze, warehouse)
    asked, real = [], type(whole := spark.range(1)).checkpoint
    monkeypatch.setattr(type(whole), "checkpoint", lambda self, *a: (
        asked.append(spark.conf.get(sinks.FREE_SHUFFLES, None)), real(self, *a))[1])
    jobs.refresh_warehouse(spark, bronze, warehouse, months=["1998-06"])
    assert len(asked) >= 2 and set(asked) == {"true"}


def test_ingested_landing_copy_is_removed(spark, monkeypatch):
    made, real = [], fixtures.lineitem_landing
    monkeypatch.setattr(fixtures, "lineitem_landing", lambda *a, **k: made.append(real(*a, **k)) or made[-1])
    assert spark.read.parquet(catalog._bronze_lineitem(spark, SF001)).count()
    assert made and not sinks._exists(spark, made[0])
