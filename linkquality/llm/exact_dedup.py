"""Exact duplicates by content hash, with the bytes compared.

Texts are grouped by a 128-bit hash of the normalised text *and* by the
normalised text itself, so two texts that merely share the hash never meet
in one class.  The grouping aggregates on the map side first: a text that a
third of all rows share reaches the shuffle once per map task.  A second,
narrow join (id, hashes) tells every row its class; its hot keys are split by
the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower


def _keyed(df: DataFrame, id_col: str, text_col: str, normalise, hash_fn) -> DataFrame:
    norm = normalise(F.coalesce(F.col(text_col), F.lit("")))
    return df.select(F.col(id_col).alias("id"), norm.alias("norm")).select(
        "id", "norm", hash_fn(F.col("norm")).alias("h"), F.sha2("norm", 256).alias("sha"))


def content_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep: str = "smallest",
                    normalise: Callable[[Column], Column] = ascii_lower,
                    hash_fn: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per distinct normalised text: h, sha, keep_id, group_size.

    ``keep`` names the row that stays, ``smallest`` or ``largest`` id.  Null
    text counts as empty.  Null ids lose against any other id; a class of
    null ids only has keep_id null.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    return (_keyed(df, id_col, text_col, normalise, hash_fn)
            .groupBy("h", "sha", "norm")
            .agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .drop("norm"))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "smallest",
                     normalise: Callable[[Column], Column] = ascii_lower,
                     hash_fn: Callable[[Column], Column] = F.md5) -> DataFrame:
    """Report, one row per input row: id, keep_id, group_size, kept, text_sha256.

    ``kept`` is true where the row's id is its class's keep_id (null-safe).
    Rows that repeat one id and one text are one document: each of them is
    reported with the same values, and ``drop_exact_duplicates`` emits that
    document once.  Null text counts as empty, empty texts are one class, an
    empty table gives an empty report, other columns are not read.  Texts
    that collide in ``h`` are told apart by bytes in the grouping and by
    SHA-256 in the join back.
    """
    rows = _keyed(df, id_col, text_col, normalise, hash_fn).drop("norm")
    classes = content_classes(df, id_col, text_col, keep, normalise, hash_fn)
    return (rows.join(classes, ["h", "sha"])
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          keep: str = "smallest",
                          normalise: Callable[[Column], Column] = ascii_lower,
                          hash_fn: Callable[[Column], Column] = F.md5) -> DataFrame:
    """The whole rows that stay, with the input's columns: one row per class.

    One aggregation: the class carries the row with the smallest (largest)
    id along, so a row needs no join to find out whether it stays.  Of rows
    that tie on the id, the one whose other columns sort first (last) stays.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    fields = [f for f in df.columns if f != id_col]
    if any(f.dataType.typeName() in ("map", "variant") for f in df.schema.fields):
        raise TypeError("columns must be orderable: no map columns")
    norm = normalise(F.coalesce(F.col(text_col), F.lit("")))
    order = F.struct(F.col(id_col).isNull() if keep == "smallest" else F.col(id_col).isNotNull(),
                     F.col(id_col), *fields)
    best = (df.select(norm.alias("norm"), order.alias("row"))
            .select(hash_fn(F.col("norm")).alias("h"), "norm", "row")
            .groupBy("h", "norm").agg(pick("row").alias("row")))
    return best.select(*[F.col("row").getField(c).alias(c) for c in df.columns])
