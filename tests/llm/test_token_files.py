import glob
import random
import struct
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkquality.llm import token_files as tf
from linkquality.llm.token_files import (TokenFile, WordEncoder, default_path, file_starts, frames_of,
                                         read_token_files, write_token_files)
from linkquality.llm.tokens import default_path as byte_path

TEXTS = ["", None, "a  b", " X ", "Don't, STOP.", "é É ﬁ Σας ΟΔΟΣ.", "日本語。 x", "tab\tand\x1cmore\xa0space", "é ́x",
         "a.,b ,, c.", "<|endoftext|> x", "İstanbul ǅ", "one\n\ntwo\r\nthree"]


def plain(text, path=None):
    return Tokenizer.from_file(path or default_path()).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [default_path(), byte_path()])
def test_memo_equals_tokenizer(path):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("abZQ.,'\n 1éÉß̈ſŉªǺΣs—\t") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    enc, fresh = WordEncoder(path, memo_words=300), Tokenizer.from_file(path)
    for t in texts:
        want = np.asarray(fresh.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert enc.encode(t) == want, repr(t)
    assert enc.by_words == (path == default_path())


def test_frames_are_cut_and_checked():
    ids = np.arange(2 * tf.FRAME_IDS + 5, dtype="<u4").tobytes()
    parts = list(frames_of(ids, zstandard.ZstdCompressor()))
    assert [n for _, n, _ in parts] == [4 * tf.FRAME_IDS, 4 * tf.FRAME_IDS, 20]
    assert b"".join(zstandard.ZstdDecompressor().decompress(f) for f, _, _ in parts) == ids
    assert len(list(frames_of(b"", zstandard.ZstdCompressor()))) == 1


ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(90, "long words " * 70_000), (50, "b a"), (50, "a b"), (None, "no id")] + \
       [(7, "hot copy of a document")] * 40


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens")) + "/out"
    df = spark.createDataFrame([(i, t, 1, b"x") for i, t in ROWS], "doc_id long, text string, id long, ids binary")
    write_token_files(df.repartition(3), path, file_bytes=400)
    return path


def test_round_trip(spark, written):
    docs = read_token_files(spark, written)
    rows = docs.join(file_starts(docs, block=4), "file_no").select("*", (F.col("base") + F.col("file_start")).alias("start"))
    got = sorted(rows.collect(), key=lambda r: r.start)
    assert len({r.file_no for r in got}) > 3
    keys = [r.id for r in got]
    assert keys == [None] + sorted(k for k, _ in ROWS if k is not None)
    want = {}
    for k, t in ROWS:
        want.setdefault(k, []).append(struct.pack(f"<{len(plain(t)) + 1}I", *plain(t), 1))
    start = 0
    for r in got:
        assert r.start == start and len(r.ids) == 4 * r.n_tokens
        want[r.id].remove(bytes(r.ids))
        start += r.n_tokens
    assert not any(want.values())
    assert sum(r.id == 7 for r in got) == 41 and len({r.file_no for r in got if r.id == 7}) > 1      # a hot id is spread


def test_only_wanted_frames_are_decompressed(spark, written, monkeypatch):
    got = read_token_files(spark, written, wanted=[90, 5, 12345]).collect()
    assert sorted(r.id for r in got) == [5, 90]
    data = next(d for d in (open(p, "rb").read() for p in glob.glob(written + "/part-*")) if d and 90 in TokenFile(d).docs["id"].to_pylist())
    file = TokenFile(data)
    opened = []
    real = file.plain

    class Watched:
        def decompress(self, frame, **kw):
            opened.append(len(frame))
            return real.decompress(frame, **kw)

    file.plain = Watched()
    k = file.docs["id"].to_pylist().index(90)
    assert len(file.ids(k)) == 4 * 140_001 and len(opened) == 3


def test_any_decoder_reads_the_stream(written):
    for p in glob.glob(written + "/part-*"):
        data = open(p, "rb").read()
        if not data:
            continue
        file = TokenFile(data)
        stream = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert stream == b"".join(file.ids(k) for k in range(len(file.docs)))


def test_damage_is_found(written):
    data = bytearray(max((open(p, "rb").read() for p in glob.glob(written + "/part-*")), key=len))
    file = TokenFile(bytes(data))
    seek = len(data) - 8 - 9 - 12 * len(file.entries)
    data[seek + 8] ^= 1                                       # the first frame's checksum
    with pytest.raises(ValueError, match="damaged"):
        TokenFile(bytes(data)).ids(0)
    with pytest.raises(ValueError):
        TokenFile(bytes(data[:-3]))


def test_empty_table_and_text_ids(spark, tmp):
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), tmp + "/none")
    assert read_token_files(spark, tmp + "/none").count() == 0
    write_token_files(spark.createDataFrame([("b", "x"), ("a", "y z")], "name string, body string"), tmp + "/named",
                      id_col="name", text_col="body", end_id=9)
    got = sorted(read_token_files(spark, tmp + "/named", "string").collect(), key=lambda r: r.file_start)
    assert [(r.id, bytes(r.ids)[-4:]) for r in got] == [("a", b"\x09\0\0\0"), ("b", b"\x09\0\0\0")]


def test_query_equals_brute_force(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    fresh, want, start = Tokenizer.from_file(default_path()), [], 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = fresh.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    got = entry.queries()["op13_token_files"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want
