import random
import re
from collections import Counter, defaultdict

import pytest

from linkquality.llm.phrases import collocations, mine


def brute(rows, longest=5, support=100, share=100, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out, frequent = [], {}
    for lang, c in f.items():
        frequent |= {(lang, " ".join(p)): v for p, v in c.items() if v >= support}
        cands = {p: v for p, v in c.items() if len(p) > 1 and v >= support}
        inside = defaultdict(int)
        for p, v in cands.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], v)
        kept = []
        for p, a in cands.items():
            if inside[p] and 100 * inside[p] >= share * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                        for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right, score))
        for rank, (_, a, p, left, right, score) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], score))
    return sorted(out), frequent


def corpus(seed, docs=60):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "neue", "york", "é", "日本", "a\x1cb", "\xa0x", "zoo"]
    rows = []
    for _ in range(docs):
        words = [rng.choice(vocab) + rng.choice(["", "", "", ".", ",", "!\n", "\r", "\t"]) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice(["en", "de", None]), rng.choice([" ", "  "]).join(words)))
    return rows + [("en", None), ("en", ""), (None, " \t. ,"), ("fr", "only once here")] + [("de", "new york city " * 40)] * 3


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    for name in ("words", "phrase", "f", "n", "k", "w"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(5, "doc_id")


@pytest.mark.parametrize("fraction,chunk", [(0.5, 137), (0.02, 4 << 20), (1.0, 11)])
def test_equals_brute_force(spark, fraction, chunk):
    rows = corpus(3)
    want, frequent = brute(rows, support=6)
    df = frame(spark, rows)
    got = collocations(df, support=6, sample_fraction=fraction, chunk=chunk)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 40
    mined = mine(df, support=6, sample_fraction=fraction, chunk=chunk)
    assert {(r.lang, r.phrase): r.f for r in mined.frequent.collect()} == frequent


def test_border_failures_lead_to_more_passes(spark):
    rows = [("en", "p q r s t. " * 9), ("en", "p q. r")] * 2
    df = frame(spark, rows)
    want, frequent = brute(rows, support=5)
    blind = mine(df, support=5, sample_fraction=0.0)          # an empty sample proposes nothing
    assert blind.passes == 2 and {(r.lang, r.phrase): r.f for r in blind.frequent.collect()} == frequent
    assert mine(df, support=5, sample_fraction=1.0).passes == 1


def test_top_share_and_empty(spark):
    rows = corpus(4)
    df = frame(spark, rows)
    assert sorted(map(tuple, collocations(df, support=4, share=60, top=7).collect())) == \
        brute(rows, support=4, share=60, top=7)[0]
    assert collocations(df.limit(0)).count() == 0
    assert collocations(df).count() == len(brute(rows)[0])


def test_long_text_in_blocks(spark):
    rows = [("en", ("alpha beta gamma " * 50_000) + ". alpha"), ("en", "x" * 3_000_000 + " y" * 120)]
    want, _ = brute(rows)
    assert sorted(map(tuple, collocations(frame(spark, rows)).collect())) == want


def test_products_beyond_64_bits(spark):
    from linkquality.llm.phrases import Mined, score_cuts
    big = 3 * 10 ** 13
    f = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 1)],
                              "lang string, words int, phrase string, f long")
    n = 10 ** 14 + 3
    got = score_cuts(Mined(f, spark.createDataFrame([("en", n)], "lang string, n long"), 1)).first()
    assert got.score == 1000 * (big - 1) * n // (big * (big + 7))
