"""Incremental landing ingest.

A scheduled ingest runs on a schedule and lets a finished ingest
trigger the transform.  Here the "which landing files are new" part is a
Structured Streaming file source: its checkpoint records every file already
seen, so a run picks up exactly the files that arrived since the last one,
and an ``availableNow`` trigger takes them and stops, which suits a scheduled
job.

The stream only learns which files are new: rows (file, delivery), written
beside the checkpoint before a batch is committed.  The files that one run sees
first are one delivery.  Then one job reads the times in all of them, whatever
batches they came in, and notes which months they touch: rows (year, month,
file, delivery).  Another replaces the touched months in bronze from all landing files that were ever
noted for them, and only those, so it makes no difference over how many files,
batches or drops a month is spread, a stray row can't replace its month, and
the work doesn't grow with the landing's history.  A test delivered again
with another record counts as that delivery has it; a file dropped twice
counts once (``plans.jobs.superseded``).  A run that fails in between leaves its list of
files, and the next run takes them along.
"""

from __future__ import annotations

import datetime as _dt
import os
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.time import settle_overlap
from ..plans.jobs import current_records, refresh_warehouse, to_bronze, with_months
from ..schema import PARTITION_KEYS
from ..sinks import delete, replace_in_two_passes
from ..sources.landing import read_landing, read_times

NOTE = "year int, month int, file string, delivery long"
ARRIVED = "file string, delivery long"
# A file as such: what is not selected of it is not read.
FILE = "path string, modificationTime timestamp, length long, content binary"


def _notes(spark: SparkSession, path: str, schema: str = NOTE) -> DataFrame:
    """The notes below ``path``; none where it does not exist yet."""
    try:
        return spark.read.schema(schema).json(path + "/*")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _write_notes(notes: DataFrame, path: str) -> None:
    notes.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def ingest_new_files(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                     tz: str = "Europe/Athens", ambiguous: str = "infer",
                     ingested_at: _dt.datetime | None = None,
                     max_files_per_batch: int | None = None):
    """Bring bronze up to date with the landing files not seen before, then
    stop.  ``checkpoint`` must be on shared storage (it is the record of seen
    files and of the months they hold).  ``max_files_per_batch`` only bounds a
    micro-batch of the file stream; the result doesn't depend on it.  Returns
    the finished ``StreamingQuery`` and the sorted ``YYYY-MM`` bronze months
    replaced."""
    arrived, pending, noted = (os.path.join(checkpoint, n) for n in ("arrived", "pending", "noted"))
    before = _notes(spark, noted).unionByName(_notes(spark, pending)).select("delivery")
    last = before.unionByName(_notes(spark, arrived, ARRIVED).select("delivery")).agg(F.max("delivery")).first()[0]
    delivery = (last or 0) + 1
    reader = spark.readStream.format("binaryFile").schema(FILE)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_batch))

    def note_files(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("delivery", F.lit(delivery)).coalesce(1).write.mode("overwrite")
         .json(os.path.join(arrived, f"batch-{batch_id}")))

    q = (reader.load(landing).select(F.col("_metadata.file_path").alias("file"))
         .writeStream.foreachBatch(note_files)
         .option("checkpointLocation", os.path.join(checkpoint, "files"))
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()

    came = _notes(spark, arrived, ARRIVED).groupBy("file").agg(F.max("delivery").alias("delivery")).collect()
    if came:
        _write_notes(_months_of(spark, landing, came, tz), os.path.join(pending, "scan"))
    new = _notes(spark, pending).select(*NOTE.replace(",", "").split()[::2])
    months = [tuple(r) for r in new.select("year", "month").distinct().collect()]    # months, not records
    if not months:
        delete(spark, arrived)
        return q, []
    touched = F.broadcast(spark.createDataFrame(months, "y int, m int"))
    same = F.col("year").eqNullSafe(F.col("y")) & F.col("month").eqNullSafe(F.col("m"))
    notes = _notes(spark, noted).unionByName(new)
    # the reader needs the list of its files on the driver in any case
    files = (notes.join(touched, same, "left_semi").groupBy("file").agg(F.max("delivery").alias("delivery")).collect())
    others = notes.join(touched, same, "left_anti").join(
        F.broadcast(spark.createDataFrame(files, ARRIVED)), "file", "left_semi").limit(1).count()

    def read(some: list[int]) -> DataFrame:
        listed = [(i, files[i]["file"], files[i]["delivery"]) for i in some]
        known = F.broadcast(spark.createDataFrame(listed, "no int, file string, delivery long"))
        raw = read_landing(spark, [unquote(f) for _, f, _ in listed], base=landing, with_file=True)
        return raw.join(known, "file").drop("file").withColumnRenamed("no", "file")

    def in_touched(raw: DataFrame) -> DataFrame:
        # a join, not a filter: a filter on the derived month would repeat the localisation
        return with_months(raw, tz).join(touched, same, "left_semi").drop(*PARTITION_KEYS)

    infer = ambiguous == "infer"
    with current_records(spark, read, [*range(len(files))], *([in_touched] if others else [])) as raw:
        rows = to_bronze(raw, tz, "earlier" if infer else ambiguous, ingested_at, flag="overlap")
        if not infer:
            rows = rows.withColumn("overlap", F.lit(False))
        replace_in_two_passes(rows.join(touched, same, "left_semi"), bronze, PARTITION_KEYS, "overlap",
                              lambda overlap: settle_overlap(overlap, tz=tz).select(*overlap.columns),
                              ("measurement_time",))
    _write_notes(new, os.path.join(noted, f"run-{delivery}"))
    delete(spark, pending)
    delete(spark, arrived)
    return q, sorted(f"{y:04d}-{m:02d}" for y, m in months if y is not None)


def _months_of(spark: SparkSession, landing: str, files: list, tz: str) -> DataFrame:
    """Notes of ``files`` (rows file, delivery).  Of the records only the times are parsed."""
    known = F.broadcast(spark.createDataFrame(files, ARRIVED))
    raw = read_times(spark, [unquote(r["file"]) for r in files], landing)
    return with_months(raw, tz).select("year", "month", "file").distinct().join(known, "file")


def ingest_and_refresh(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                       warehouse: str, **kw) -> list[str]:
    """New landing files -> bronze, then, if any month changed, the warehouse:
    only the changed silver months are re-cleaned, sessions and gold are
    rebuilt (a finished ingest triggers the transform).
    Returns the months that changed."""
    _, months = ingest_new_files(spark, landing, bronze, checkpoint, **kw)
    if months:
        refresh_warehouse(spark, bronze, warehouse, months=months)
    return months
