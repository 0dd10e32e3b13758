"""Corpus pipeline over ``documents``.

Five stages, each one operator of ``linkquality.llm``; each is written as
Parquet and read again as the next one's input.  All but the last return the
columns of ``documents``:

1. toxicity: documents that the model scores 0.7 or more go;
2. exact dedup: of texts equal after lower-casing A-Z the largest id stays;
3. near-dedup: of texts that SimHash links (three-word shingles, two bits at
   most apart) connect, the smallest id stays;
4. decontamination: benchmark passages are cut out of the texts (``n_chars``
   follows), documents that are benchmark text for more than half go;
5. packing: the pieces, with a digest of their token ids.

The stages learn from labels or tokenise, which SQL can't express, so there is
no statement for the whole; tests hold each stage and the run against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkquality.conf import scratch_path
from linkquality.llm.catalog import toxicity_training
from linkquality.llm.common import table
from linkquality.llm.decontaminate import decontaminate
from linkquality.llm.exact_dedup import drop_exact_duplicates
from linkquality.llm.packing import pack_documents, piece_digest
from linkquality.llm.simhash import drop_near_duplicates
from linkquality.llm.toxicity import drop_toxic, fit

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, fit(docs, table(spark, sf_dir, "labels"), toxicity_training()), threshold=0.7)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, radius=2, shingle=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"),
                         length_col="n_chars" if "n_chars" in docs.columns else None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digest(pack_documents(docs))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the intermediate tables lie in the
    shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
