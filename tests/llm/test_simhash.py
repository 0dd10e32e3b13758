import random
import re

import numpy as np
import xxhash

from linkquality.llm.simhash import components, drop_near_duplicates, forest, near_duplicates, near_links


def brute_print(t, k=3):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i:i + k]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, radius):
    """Smallest position of each value's component."""
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def docs(seed):
    rng = random.Random(seed)
    make = lambda n: [rng.choice("alpha beta Gamma delta é zeta eta".split()) + str(rng.randint(0, 99)) for _ in range(n)]
    rows = []
    for _ in range(25):
        w = make(rng.randint(0, 120))
        rows.append(" ".join(w))
        for _ in range(rng.randint(0, 4)):
            v = list(w)
            if v:
                v[rng.randrange(len(v))] = "changed"
            rows.append("\n".join(v))
    rows += [None, "", " \t", "one", "One", "two words", "long " * 60_000, "x" * 300_000]
    return [(i * 7 % 1000, t) for i, t in enumerate(rows)] + [(3, rows[0]), (None, rows[1])]


def test_components_equal_brute_force(docs_of):
    rows = docs(1)
    prints = [brute_print(t) for _, t in rows]
    root = classes(prints, 2)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((repr((i, p, least[r])) for (i, _), p, r in zip(rows, prints, root)))
    got = near_duplicates(docs_of(rows), tile=8).collect()
    assert sorted(repr((r.doc_id, r.fp % 2 ** 64, r.component_id)) for r in got) == want
    assert len(set(root)) < len(set(prints))          # some links are not copies

    kept = drop_near_duplicates(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    ids = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert ids == sorted(set(least.values()))


def test_no_link_is_lost_in_crowded_cells(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = set(base)
    for b in base:
        for _ in range(40):
            v = b
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values | {0, 1, 3, 2 ** 64 - 1, 2 ** 64 - 2})
    signed = [(v - 2 ** 64 if v >= 2 ** 63 else v,) for v in values]
    frame = spark.createDataFrame(signed, "fp long")
    for tile in (3, 2048):
        found = {r.node % 2 ** 64: r.root % 2 ** 64 for r in components(near_links(frame, 2, tile)).collect()}
        mine = {}
        for v in values:
            mine.setdefault(found.get(v, v), set()).add(v)
        theirs = {}
        for v, r in zip(values, classes(values, 2)):
            theirs.setdefault(r, set()).add(v)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_forest_is_small_and_connects():
    values = np.array(sorted({1 << a | 1 << b for a in range(64) for b in range(64)}), np.uint64)
    a, b = forest(values, values, True, 2)
    assert 0 < len(a) < len(values)


def test_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 50)}


def test_empty(docs_of):
    assert near_duplicates(docs_of([])).count() == 0
    assert drop_near_duplicates(docs_of([])).count() == 0
