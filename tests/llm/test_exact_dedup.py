import hashlib

from pyspark.sql import functions as F

from linkquality.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[low(t)] if x is not None]
        best = (max if keep == "largest" else min)(ids) if ids else None
        out.append((i, best, len(groups[low(t)]), i == best, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [(1, "Hello"), (2, "hELLO"), (3, "Élan"), (4, "élan"), (5, None), (6, ""), (7, " "), (8, "HELLO"),
        (None, "hello"), (None, "only null"), (9, "a" * 200_000), (10, "A" * 200_000), (11, "x"), (11, "x"), (11, "y")]


def report(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_report_equals_brute_force(docs_of):
    for keep in ("largest", "smallest"):
        assert report(exact_duplicates(docs_of(ROWS), keep=keep)) == brute(ROWS, keep)


def test_colliding_hash_is_told_apart_by_bytes(docs_of):
    weak = lambda c: F.substring(F.md5(c), 1, 1)
    rows = [(i, f"text {i % 40}") for i in range(200)]
    assert report(exact_duplicates(docs_of(rows), keep="largest", hash_fn=weak)) == brute(rows, "largest")
    kept = drop_exact_duplicates(docs_of(rows), keep="largest", hash_fn=weak)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(160, 200))


def test_drop_keeps_whole_rows_once(docs_of):
    df = docs_of(ROWS)
    kept = drop_exact_duplicates(df, keep="largest")
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(8, "HELLO"), (3, "Élan"), (4, "élan"), (6, ""), (7, " "), (None, "only null"),
                          (10, "A" * 200_000), (11, "x"), (11, "y")], key=repr)


def test_empty_table(docs_of):
    assert exact_duplicates(docs_of([])).count() == 0
    assert drop_exact_duplicates(docs_of([])).count() == 0


def test_plan_is_native(docs_of):
    plan = exact_duplicates(docs_of(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
