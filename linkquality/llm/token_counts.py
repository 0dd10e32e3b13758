"""Exact histogram of encoded lengths, and what every context limit costs.

Documents are counted by their exact number of token ids, first in the map
tasks, then across them.  Prefix and suffix sums over the lengths answer how
many documents and ids lie below, at or above every limit and how many ids
remain when documents are truncated there.  The sums run in two levels
(blocks of lengths, then lengths in a block), so no window holds more than a
block, however many lengths occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import checkpointed
from .tokens import default_path

BLOCK = 1024


def encoded_lengths(df: DataFrame, text_col: str = "text", tokenizer_path: str | None = None,
                    out: str = "n_tokens") -> DataFrame:
    """``df`` with the number of token ids of every whole text (null: 0)."""
    path = tokenizer_path or default_path()

    def lengths(texts):
        import pyarrow as pa

        from .tokens import encoder
        return pa.array([len(ids) // 4 for ids in encoder(path).encode_all(texts)], pa.int64())

    return df.withColumn(out, F.arrow_udf(lengths, "long")(F.col(text_col).cast("string")))


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens",
                     block: int = BLOCK) -> DataFrame:
    """One row per length that occurs, for each the whole corpus's answers:

    * ``n_docs``, ``n_tokens``: documents of this length and their ids;
    * ``docs_upto``, ``tokens_upto``: of this length or shorter;
    * ``docs_over``, ``tokens_over``: longer ones;
    * ``truncated_tokens``: ids left when every document is cut at this
      length (``tokens_upto + length * docs_over``);
    * ``total_docs``, ``total_tokens``.

    Null lengths count as 0; an empty table gives no rows.
    """
    length = F.coalesce(F.col(length_col), F.lit(0)).cast("long")
    # written once: everything below reads one row per length, not the texts again
    hist = (checkpointed(lengths.select(length.alias("length")).groupBy("length")
                         .agg(F.count(F.lit(1)).alias("n_docs")))
            .withColumn("n_tokens", F.col("length") * F.col("n_docs"))
            .withColumn("block", F.floor(F.col("length") / F.lit(block))))
    # at most max length / block rows meet in this window
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = (hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
              .select("block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
                                 for c in "dt"],
                      F.sum("d").over(whole).alias("total_docs"),
                      F.sum("t").over(whole).alias("total_tokens")))
    inside = Window.partitionBy("block").orderBy("length")
    return (hist.join(blocks, "block")
            .withColumn("docs_upto", F.col("d_before") + F.sum("n_docs").over(inside))
            .withColumn("tokens_upto", F.col("t_before") + F.sum("n_tokens").over(inside))
            .select("length", "n_docs", "n_tokens", "docs_upto", "tokens_upto",
                    (F.col("total_docs") - F.col("docs_upto")).alias("docs_over"),
                    (F.col("total_tokens") - F.col("tokens_upto")).alias("tokens_over"),
                    (F.col("tokens_upto") + F.col("length")
                     * (F.col("total_docs") - F.col("docs_upto"))).alias("truncated_tokens"),
                    "total_docs", "total_tokens"))


def truncated_total(hist: DataFrame, limit: int) -> DataFrame:
    """One row: total_docs, total_tokens, truncated_tokens and truncated_docs
    for any limit, from the histogram's rows alone."""
    over = F.col("length") > F.lit(limit)
    return hist.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("total_docs"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum(F.least("length", F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("truncated_tokens"),
        F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0)).alias("truncated_docs"))


def length_quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """Exact quantiles: for each share the smallest length such that at least
    that share of the documents is no longer.  Empty histogram: no rows."""
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    return (hist.select("length", "docs_upto", "total_docs", wanted)
            .where("docs_upto >= share * total_docs")
            .groupBy("share").agg(F.min("length").alias("length")))
