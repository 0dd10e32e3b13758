"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces whose lengths are powers of two:
as many of the longest length as fit, then one for each set bit of the rest.
Every piece is a sequence of its own, so no sequence crosses documents and
none is padded; batches are formed from the buckets of equal lengths.  The
operator is one pass without a shuffle: its memory is a document's ids and
its work is the same for every document, whatever source or key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tokens import default_path

PIECE = "start long, length long, ids binary, doc_tokens long"


def binary_lengths(n: int, longest: int) -> list[int]:
    """n as a sum of powers of two, none above ``longest``, longest first."""
    full, rest = divmod(n, longest)
    return [longest] * full + [1 << b for b in reversed(range(longest.bit_length()))
                               if rest >> b & 1]


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   max_length: int = 1024, end_id: int = 0,
                   tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, sequence_id,
    offset, bucket.

    ``ids`` are the piece's token ids as little-endian uint32 bytes, ``start``
    the number of its document's ids before it, ``bucket`` the power of two
    whose bucket it joins (its length).  A document is its text's ids and then
    ``end_id``; null and empty texts are ``end_id`` alone; a row repeated in
    the input is packed as often as it occurs; an empty table gives no
    pieces; other columns are not read.  ``sequence_id`` is unique within the
    result, not dense; it depends on how the input files are split into
    partitions, not on task order, so a task that runs again gives the same.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    path = tokenizer_path or default_path()
    fields = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {fields.schema['id'].dataType.simpleString()}, {PIECE}"

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        from .tokens import encoder
        end = np.asarray([end_id], dtype="<u4").tobytes()
        out_schema, enc = None, encoder(path)
        for batch in batches:
            out_schema = out_schema or pa.schema(
                [("id", batch.schema.field("id").type), ("start", pa.int64()),
                 ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])
            rows, starts, lengths, ids, totals, size = [], [], [], [], [], 0

            def flush():
                keys = batch.column("id").take(pa.array(rows, pa.int64()))
                return pa.RecordBatch.from_arrays(
                    [keys, pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(totals, pa.int64())],
                    schema=out_schema)

            for k, found in enumerate(enc.encode_all(batch.column("text"))):
                data = found + end
                n, start = len(data) // 4, 0
                for length in binary_lengths(n, max_length):
                    rows.append(k)
                    starts.append(start)
                    lengths.append(length)
                    ids.append(data[4 * start:4 * (start + length)])
                    totals.append(n)
                    start, size = start + length, size + length
                    if size > 1 << 18:
                        yield flush()
                        rows, starts, lengths, ids, totals, size = [], [], [], [], [], 0
            if rows:
                yield flush()

    pieces = fields.mapInArrow(pack, schema)
    return pieces.select(F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens",
                         F.monotonically_increasing_id().alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"), F.col("length").alias("bucket"))


def piece_digest(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with a CRC-32 of their ids' bytes in place of the ids."""
    return pieces.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "bucket")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Training files, one folder per length (``bucket=<length>``), each
    bucket split over as many files as its rows need."""
    (pieces.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path))
