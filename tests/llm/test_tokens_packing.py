import random
import string
import struct
import zlib
from collections import defaultdict

import pyarrow as pa

from linkquality.llm import tokens
from linkquality.llm.packing import binary_lengths, pack_documents, piece_digest, write_buckets
from linkquality.llm.token_counts import encoded_lengths, length_histogram, length_quantiles, truncated_total
from linkquality.llm.tokens import Encoder, default_path

TEXTS = ["a  b", " x", "x ", "a\n\nb", "it's don't", "a.\tb", "\xa0x y", "x\n y", "a b\n", "<|endoftext|> x",
         "1. 2,3. a1. é, ñ.", "—x y—", "a .b ,", "\n", "日本 語。 x", "...", "a.. b,, c.", "", "x y z", "​x a"]


def test_memo_equals_tokenizer():
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abZ.,\n 1é's—\t") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    enc = Encoder(default_path(), memo_words=500)
    for t in texts:
        assert enc.encode(t) == enc.whole(t), repr(t)


def test_all_texts_at_once_equal_tokenizer(monkeypatch):
    rng = random.Random(5)
    texts = [None, *TEXTS, "née, où. l'été,\nÀ la. vu à x, …, ½, x²."] + [
        " ".join("".join(rng.choice("abcdeéà.,'1") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 60)))
        for _ in range(1500)]
    texts += [" ".join(map(str, range(700))), "a.b, " * 300, "日本語。" * 200, "x" * 3000, "a b " * 400 + "<|endoftext|> x"]
    enc = Encoder(default_path(), memo_words=800)
    assert enc.memo
    want = [enc.whole(t or "") for t in texts]
    assert list(enc.encode_all(pa.array(texts))) == want
    assert list(enc.encode_all(pa.array(texts, pa.large_string()).slice(7))) == want[7:]
    assert list(enc.encode_all(pa.array([], pa.string()))) == []
    monkeypatch.setattr(tokens, "SLICE_BYTES", 500)        # long texts go in parts
    assert list(enc.encode_all(pa.array(texts))) == want
    enc.memo = False
    assert list(enc.encode_all(pa.array(texts[:50]))) == want[:50]


class Counted:
    """The library's tokenizer or model, counting calls."""

    def __init__(self, inner, calls):
        self.inner, self.calls = inner, calls

    def tokenize(self, text):
        self.calls.append(text)
        return self.inner.tokenize(text)

    def encode(self, text, **how):
        self.calls.append(text)
        return self.inner.encode(text, **how)


def test_new_words_share_calls_of_the_library(docs_of):
    rng = random.Random(7)
    words = ["".join(rng.choices(string.ascii_lowercase, k=8)) for _ in range(4000)]
    texts = [" ".join(words[at:at + 100]) + "." for at in range(0, 4000, 100)]
    enc = Encoder(default_path())
    calls = []
    enc.model, enc.tokenizer = Counted(enc.model, calls), Counted(enc.tokenizer, calls)
    got = list(getattr(enc, "encode_all", lambda a: map(enc.encode, a.to_pylist()))(pa.array(texts)))
    assert len(calls) < 200                     # one a new word: 4000
    calls.clear()
    assert list(enc.encode_all(pa.array(texts))) == got and not calls
    assert got == [enc.whole(t) for t in texts]


def test_memo_is_bounded():
    enc = Encoder(default_path(), memo_words=1000)
    for at in range(0, 20000, 100):
        next(enc.encode_all(pa.array([" ".join(f"w{k}" for k in range(at, at + 100))])))
        assert len(enc.known) <= 1000 and len(enc.sizes) == len(enc.met) == len(enc.known)
        assert len(enc.ids) == enc.sizes.sum()


def test_binary_lengths():
    for n in (1, 2, 3, 1023, 1024, 1025, 5000):
        parts = binary_lengths(n, 1024)
        assert sum(parts) == n and parts == sorted(parts, reverse=True)
        assert all(p & (p - 1) == 0 and p <= 1024 for p in parts)


ROWS = [(1, "the quick brown fox " * 900), (2, None), (3, ""), (4, "one"), (4, "one"), (None, "x y z")] + \
       [(10 + i, t) for i, t in enumerate(TEXTS)]


def test_pieces_round_trip(docs_of):
    enc = Encoder(default_path())
    pieces = pack_documents(docs_of(ROWS)).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    rebuilt = defaultdict(list)
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= 1024 and len(p.ids) == 4 * p.length
        assert p.offset == 0 and p.bucket == p.length
        rebuilt[p.doc_id].append((p.start, bytes(p.ids), p.doc_tokens))
    for i, t in ROWS:
        want = enc.whole(t or "") + struct.pack("<I", 0)
        parts = sorted(rebuilt[i])
        if i == 4:                                  # the repeated row is packed twice
            assert parts[::2] == parts[1::2]
            parts = parts[::2]
        assert b"".join(x for _, x, _ in parts) == want
        assert all(n == len(want) // 4 for *_, n in parts)


def test_digest_and_buckets(docs_of, spark, tmp):
    pieces = pack_documents(docs_of(ROWS[:5]))
    crc = {(p.doc_id, p.start): zlib.crc32(bytes(p.ids)) for p in pieces.collect()}
    assert {(p.doc_id, p.start): p.ids_crc32 for p in piece_digest(pieces).collect()} == crc
    write_buckets(pieces, tmp + "/b")
    back = spark.read.parquet(tmp + "/b")
    assert back.count() == pieces.count() and back.where("bucket <> length").count() == 0


def test_empty(docs_of):
    assert pack_documents(docs_of([])).count() == 0
    assert length_histogram(encoded_lengths(docs_of([]))).count() == 0


def test_histogram_answers(docs_of):
    enc = Encoder(default_path())
    sizes = [len(enc.whole(t or "")) // 4 for _, t in ROWS]
    hist = length_histogram(encoded_lengths(docs_of(ROWS).select("text")), block=4)
    rows = {r.length: r for r in hist.collect()}
    assert set(rows) == set(sizes)
    for n, r in rows.items():
        assert r.n_docs == sizes.count(n) and r.n_tokens == n * r.n_docs
        assert r.docs_upto == sum(s <= n for s in sizes) and r.tokens_upto == sum(s for s in sizes if s <= n)
        assert r.docs_over == sum(s > n for s in sizes) and r.tokens_over == sum(s for s in sizes if s > n)
        assert r.truncated_tokens == sum(min(s, n) for s in sizes)
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
    for limit in (0, 3, 1000, 10 ** 6):
        r = truncated_total(hist, limit).first()
        assert r.truncated_tokens == sum(min(s, limit) for s in sizes)
        assert r.truncated_docs == sum(s > limit for s in sizes)
    q = {r.share: r.length for r in length_quantiles(hist, [0.1, 0.5, 1.0]).collect()}
    ranked = sorted(sizes)
    for share, length in q.items():
        assert length == next(s for k, s in enumerate(ranked, 1) if k >= share * len(ranked)
                              and sum(x <= s for x in ranked) >= share * len(ranked))
