import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.llm.test_decontaminate import brute as brute_hits  # noqa: E402
from tests.llm.test_exact_dedup import low  # noqa: E402
from tests.llm.test_simhash import brute_print, classes  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_each_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]

    clean = stages["toxicity"](spark, docs, SF)
    toxic = {r.doc_id for r in entry.queries()["op8_toxicity"](spark, SF).where("predicted = 1").collect()}
    assert clean.columns == docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in clean.collect()}
    assert after == {i: t for i, t in before.items() if i not in toxic} and toxic

    kept = {r.doc_id: r.text for r in stages["exact_dedup"](spark, docs, SF).collect()}
    last = {}
    for i in sorted(before):
        last[low(before[i])] = i
    assert kept == {i: before[i] for i in last.values()}

    ids = sorted(before)
    root = classes([brute_print(before[i]) for i in ids], 2)
    near = stages["near_dedup"](spark, docs, SF)
    assert near.columns == docs.columns
    assert sorted(r.doc_id for r in near.collect()) == sorted({ids[r] for r in root})

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = {i: (n, h) for i, n, h, _ in brute_hits(list(before.items()), items)}
    out = stages["decontamination"](spark, docs, SF)
    rest = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
    assert set(rest) == {i for i, (n, h) in hits.items() if h <= 0.5 * n}
    for i, (text, size) in rest.items():
        assert (text == before[i]) == (hits[i][1] == 0) and size == len(text)
    assert all(h == 0 for _, _, h, _ in brute_hits([(i, t) for i, (t, _) in rest.items() if hits[i][1]], items))


def test_run_chains_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    want = sorted(tuple(r) for r in docs.select(key).collect())
    assert sorted(tuple(r) for r in entry.queries()["pipeline"](spark, SF).select(key).collect()) == want
    assert want


def test_stages_on_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_all_queries_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(entry.oracle_sql()) <= set(names)
