"""Token-id files of independent zstandard frames with a trailing seek table.

A token file holds the ids of whole documents as little-endian uint32:

* frames: every document is one zstandard frame, or several where it has more
  than ``FRAME_IDS`` ids; no frame holds ids of two documents;
* document table: a skippable frame (magic 0x184D2A51) with a compressed
  Arrow table of the ids' owners, their numbers of ids and of frames, and the
  file's number in the order of all files;
* seek table: a skippable frame (magic 0x184D2A5E) with one entry a frame
  (stored bytes, plain bytes, low 32 bits of the plain bytes' XXH64), then the
  number of frames, a flag byte and the magic 0x8F92EAB1.

Behind each of these stands ``SEPARATOR``, an empty skippable frame; an
entry's stored bytes include it.  So any zstandard decoder reads the file as
one stream, and a reader that knows the tables decompresses only the frames
of the documents it wants.

The separator is what makes Spark's own text writer able to write the files:
each row is one frame, its line separator the empty frame.  Files therefore
go through Spark's commit protocol to any file system Spark can write, and a
task that runs again leaves nothing behind.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import held
from .tokens import BYTE_LETTERS

TOKENIZER = "word_bpe_49k.json"
FRAME_IDS = 1 << 16
FILE_BYTES = 32 << 20
# Fixed values of the zstandard container formats.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)
DOC_TABLE_MAGIC, SEEK_TABLE_MAGIC, SEEK_FOOTER_MAGIC = 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
FOOTER = struct.Struct("<IBI")


# ----------------------------------------------------------------- encoding

class _Memo(dict):
    """Ids, as bytes, of words.  Two generations of ``size`` words at most: a
    word met again moves to the younger one, the older one is let go."""

    def __init__(self, ids_of, size: int):
        super().__init__({"": b""})
        self.ids_of, self.size, self.old = ids_of, size, {}

    def __missing__(self, word: str) -> bytes:
        if word.endswith((".", ",")) and word[-2:-1].isalpha():
            return self[word[:-1]] + self[word[-1]]             # not worth a place of its own
        ids = self.old.get(word)
        if ids is None:
            ids = self.ids_of(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordEncoder:
    """``encode(text)``: ids as little-endian uint32 bytes.

    A vocabulary that drops white space encodes a text word by word, and texts
    repeat most words, so ids of words are remembered (``memo_words`` bounds
    the memory, about 200 bytes a word).  Words are cut at blanks, line feeds
    and before a last stop behind a letter; every other character is left to the tokenizer, but words of
    Latin letters, one piece to a normaliser and pre-tokenizer that pass the
    trial, go straight to its BPE model.  Texts with the string of
    an added token, and all texts where the trial shows that the vocabulary
    does not encode by words, are encoded whole."""

    def __init__(self, path: str, memo_words: int = 400_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = _Memo(self.word, memo_words)
        sample = "Plain words,  and É ones.\nIt's 2 (two) \"lines\" of x1. Jumping quicksilver, overzealously naïveté"
        words = sample.replace("\n", " ").split(" ")
        self.by_words = (b"".join(map(self.whole, words)) == self.whole(sample) == self.whole(sample.lower())
                         and all(self.letters(w) == self.whole(w) for w in words if w.isalpha() and w.islower()))

    def whole(self, text: str) -> bytes:
        import numpy as np
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def letters(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def word(self, word: str) -> bytes:
        if word.isalpha() and max(word) < "\u0250" and "\u0130" not in word:
            return self.letters(word) if word.islower() else self.memo[word.lower()]
        return self.whole(word)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_words or any(t in text for t in self.added):
            return self.whole(text)
        try:            # in Latin-1 no character is normalised or lower-cased by its neighbours
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
        return b"".join(map(self.memo.__getitem__, text.replace("\n", " ").split(" ")))


# ------------------------------------------------------------------ writing

def frames_of(ids: bytes, compressor):
    """(stored frame, number of plain bytes, checksum) of each frame."""
    from xxhash import xxh64_intdigest
    for at in range(0, len(ids), 4 * FRAME_IDS) or (0,):
        plain = ids[at:at + 4 * FRAME_IDS]
        yield compressor.compress(plain), len(plain), xxh64_intdigest(plain) & 0xFFFFFFFF


def skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


def tables_of(docs, entries: list[tuple[int, int, int]], file_no: int) -> tuple[bytes, bytes]:
    """Document table and seek table; ``docs`` is an Arrow table."""
    import numpy as np
    import pyarrow as pa
    docs = docs.replace_schema_metadata({"file_no": str(file_no)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(docs)
    rows = np.asarray(entries, "<u4").tobytes()
    return (skippable(DOC_TABLE_MAGIC, sink.getvalue().to_pybytes()),
            skippable(SEEK_TABLE_MAGIC, rows + FOOTER.pack(len(entries), 0x80, SEEK_FOOTER_MAGIC)))


def write_token_files(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 1, tokenizer_path: str | None = None,
                      file_bytes: int = FILE_BYTES, level: int = 3) -> None:
    """Encode every whole text, append ``end_id`` to each document and write
    the ids in ascending id order (null ids first) under ``path``.

    Null and empty texts are ``end_id`` alone; rows that share an id follow
    each other by their texts' hashes; a repeated row is written as often as
    it occurs; an empty table gives no document; other columns are not read.
    The rows are cut into ranges of ids, hashes and, where both are equal,
    row numbers, about ``file_bytes`` of text each and one file a range, so a
    hot id spreads over files too.  A task holds one document and the two
    tables of its file."""
    path_of = tokenizer_path or default_path()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keys = ["id", "hash", "row"]
    ranged = (rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
              .repartitionByRange(max(1, -(-size // file_bytes)), *keys).sortWithinPartitions(*keys)
              .select("id", "text"))

    def write(batches):
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext
        enc = held(("word encoder", path_of), lambda: WordEncoder(path_of))
        end, squeeze = struct.pack("<I", end_id), zstandard.ZstdCompressor(level=level)
        docs, entries = [], []

        def out(chunks):
            return pa.RecordBatch.from_arrays([pa.array(chunks, pa.binary())], names=["frame"])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part, ready, tokens, frames = batch.slice(at, 128), [], [], []
                for text in part.column("text").to_pylist():
                    ids = enc.encode(text) + end
                    n = len(entries)
                    for frame, plain, check in frames_of(ids, squeeze):
                        ready.append(frame)
                        entries.append((len(frame) + len(SEPARATOR), plain, check))
                    tokens.append(len(ids) // 4)
                    frames.append(len(entries) - n)
                docs.append(pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(tokens, pa.int64()), pa.array(frames, pa.int32())],
                    names=["id", "n_tokens", "frames"]))
                yield out(ready)
        if docs:
            yield out(tables_of(pa.Table.from_batches(docs), entries, TaskContext.get().partitionId()))

    (ranged.mapInArrow(write, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", SEPARATOR.decode()).text(path))


def default_path() -> str:
    """The vocabulary file installed beside the libraries."""
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


# ------------------------------------------------------------------ reading

class TokenFile:
    """The documents of one token file, given as bytes.

    ``docs`` is the Arrow table (id, n_tokens, frames), ``file_no`` the file's
    number; ``ids(k)`` decompresses the frames of the k-th document, and only
    those, and checks their checksums."""

    def __init__(self, data):
        import numpy as np
        import pyarrow as pa
        import zstandard
        self.data, tail = memoryview(data), len(data) - len(SEPARATOR)
        count, _, magic = FOOTER.unpack_from(self.data, tail - FOOTER.size)
        if magic != SEEK_FOOTER_MAGIC or bytes(self.data[tail:]) != SEPARATOR:
            raise ValueError("not a token file")
        table = tail - FOOTER.size - 12 * count
        self.entries = np.frombuffer(self.data[table:table + 12 * count], "<u4").reshape(count, 3)
        self.at = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        magic, size = struct.unpack_from("<II", self.data, int(self.at[-1]))
        if magic != DOC_TABLE_MAGIC:
            raise ValueError("no document table behind the frames")
        start = int(self.at[-1]) + 8
        self.docs = pa.ipc.open_stream(pa.py_buffer(self.data[start:start + size])).read_all().combine_chunks()
        self.file_no = int(self.docs.schema.metadata[b"file_no"])
        self.first = np.concatenate([[0], np.cumsum(self.docs["frames"].to_numpy())])
        self.plain = zstandard.ZstdDecompressor()

    def ids(self, k: int) -> bytes:
        from xxhash import xxh64_intdigest
        out = []
        for n in range(int(self.first[k]), int(self.first[k + 1])):
            stored, size, check = self.entries[n].tolist()
            start = int(self.at[n])
            data = self.plain.decompress(self.data[start:start + stored - len(SEPARATOR)], max_output_size=size)
            if len(data) != size or xxh64_intdigest(data) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {n} of file {self.file_no} is damaged")
            out.append(data)
        return b"".join(out)


def read_token_files(spark: SparkSession, path: str, id_type: str = "long",
                     wanted: Sequence | None = None) -> DataFrame:
    """id, file_no, file_start (ids before it in its file), n_tokens, ids
    (binary) of every document under ``path``; with ``wanted``, a list of ids,
    only of those, and no other frame is decompressed."""

    def read(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            for content in batch.column("content"):
                if not content.as_buffer().size:
                    continue
                file = TokenFile(content.as_buffer())
                n = file.docs["n_tokens"].to_numpy()
                starts = n.cumsum() - n
                rows = range(len(n))
                if wanted is not None:
                    keys = file.docs["id"].combine_chunks()
                    rows = pc.indices_nonzero(pc.is_in(keys, pa.array(wanted, keys.type))).to_pylist()
                part, size = [], 0
                for at, k in enumerate(rows, 1):
                    part.append((k, file.ids(k)))
                    size += len(part[-1][1])
                    if size > 1 << 20 or at == len(rows):
                        which = pa.array([p[0] for p in part], pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pc.take(file.docs["id"].combine_chunks(), which),
                             pa.array([file.file_no] * len(part), pa.int64()),
                             pa.array(starts[which.to_numpy()], pa.int64()),
                             pa.array(n[which.to_numpy()], pa.int64()),
                             pa.array([p[1] for p in part], pa.binary())],
                            names=["id", "file_no", "file_start", "n_tokens", "ids"])
                        part, size = [], 0

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(read, f"id {id_type}, file_no long, file_start long, n_tokens long, ids binary")


def file_starts(docs: DataFrame, block: int = 1024) -> DataFrame:
    """file_no and the number of ids in all files before it; running sums
    inside blocks of files, then over the blocks."""
    files = (docs.groupBy("file_no").agg(F.sum("n_tokens").alias("size"))
             .withColumn("block", F.floor(F.col("file_no") / block)))

    def before(*by) -> Column:
        rows = Window.partitionBy(*by).orderBy("file_no" if by else "block")
        return F.sum("size").over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")

    sums = files.groupBy("block").agg(F.sum("size").alias("size"))
    blocks = sums.select("block", before().alias("base"))
    return (files.select("file_no", "block", before("block").alias("inner")).join(blocks, "block")
            .select("file_no", (F.col("base") + F.col("inner")).alias("base")))
