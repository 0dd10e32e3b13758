"""Chat formatting by perspective rotation.

A dialogue of several speakers becomes one training text per speaker: in it
that speaker is the assistant, the others are users with their names, and the
loss mask covers the assistant's own messages.  System messages stay system
messages and nobody's perspective.

Everything is built-in functions.  The messages of a dialogue are numbered in
two levels (position in a range of one sort, messages in the ranges before)
and rendered in parts of ``part_messages``, each a group of its own, so a
dialogue that holds a third of all rows is spread over many tasks, whatever
its turn numbers are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import checkpointed

SYSTEM = "system"
END = "<|end|>\n"


def perspectives(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 speaker_col: str = "role", text_col: str = "text",
                 part_messages: int = 256) -> DataFrame:
    """One row per (conversation, speaker, part): conv, perspective, part,
    n_messages, n_trained, rendered, mask.

    ``rendered`` is the part's messages in order of turn, then speaker, then
    text: ``<|system|>``, ``<|assistant|>`` or ``<|user:NAME|>``, a line feed,
    the text and ``<|end|>``.  ``mask`` lists, as ``start-end`` character
    positions in ``rendered``, what the loss covers: text and end mark of each
    assistant message.  ``part`` is the message's number in that order (from
    0) over ``part_messages``, rounded down.  Parts where the speaker is silent
    are rendered too (an empty mask), so the parts of a perspective give the
    whole dialogue.

    Null text counts as empty; a null or empty speaker is the speaker
    ``unknown``; messages repeated in all four columns are one message; a row
    without conversation or turn can't be placed and is a dialogue of its
    own (part null); dialogues of system messages only have no perspective;
    an empty table gives no rows; other columns are not read.
    """
    rows = (df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                      F.coalesce(F.nullif(F.col(speaker_col), F.lit("")), F.lit("unknown")).alias("who"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    whole = F.col("conv").isNotNull() & F.col("turn").isNotNull()
    placed = _numbered(rows.where(whole).distinct(), part_messages)
    speakers = (rows.where(whole & (F.col("who") != SYSTEM))
                .select("conv", F.col("who").alias("perspective")).distinct())
    parts = placed.groupBy("conv", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "who", "text"))).alias("messages"))
    alone = (rows.where(~whole & (F.col("who") != SYSTEM))
             .select("conv", F.lit(None).cast("long").alias("part"),
                     F.array(F.struct("turn", "who", "text")).alias("messages"),
                     F.col("who").alias("perspective")))
    seen = parts.join(speakers, "conv").select("conv", "part", "messages", "perspective")
    return _rendered(seen.unionByName(alone)).withColumnRenamed("conv", conv_col)


def _numbered(placed: DataFrame, size: int) -> DataFrame:
    """``placed`` with its messages' parts of ``size`` each.

    A message's number is its position in its range of one sort over all
    columns plus the messages of its dialogue in the ranges before, so no task
    holds a dialogue."""
    at = checkpointed(placed.sort("conv", "turn", "who", "text")
                      .withColumn("at", F.monotonically_increasing_id())
                      .withColumn("range", F.shiftright("at", 33)))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (at.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
              .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    return (at.join(starts, ["conv", "range"])
            .select("conv", "turn", "who", "text",
                    F.floor((F.col("at") - F.col("first") + F.col("before")) / F.lit(size)).alias("part")))


def _rendered(seen: DataFrame) -> DataFrame:
    own = F.col("perspective")
    pieces = F.transform("messages", lambda m: F.struct(
        F.when(m["who"] == SYSTEM, "<|system|>\n").when(m["who"] == own, "<|assistant|>\n")
        .otherwise(F.concat(F.lit("<|user:"), m["who"], F.lit("|>\n"))).alias("head"),
        F.concat(m["text"], F.lit(END)).alias("body"), (m["who"] == own).alias("trained")))
    spans = F.aggregate(
        "pieces", F.struct(F.lit(0).cast("long").alias("at"),
                           F.array().cast("array<string>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).alias("at"),
            F.when(p["trained"], F.array_append(acc["spans"], F.concat_ws(
                "-", (acc["at"] + F.char_length(p["head"])).cast("string"),
                (acc["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).cast("string"))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return (seen.withColumn("pieces", pieces)
            .select("conv", "perspective", "part", F.size("pieces").cast("long").alias("n_messages"),
                    F.size(F.filter("pieces", lambda p: p["trained"])).cast("long").alias("n_trained"),
                    F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "")
                    .alias("rendered"),
                    F.array_join(spans, ",").alias("mask")))
