"""Table writes (K1-K4): staged, then put in place.

New files are written to a hidden folder ``_staging-<id>`` inside the table's
folder, which no reader looks at.  Only when all of them are there is the list
of what goes and what comes recorded in one file, and from then on the
replacement is decided: the folders are renamed into place, and if the job
dies in between, ``finish`` (which every write starts with) carries on from
the record.  A job that fails before that point leaves the table as it was.
So a step may also read the table that it replaces.  A table has one writer
at a time.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from .schema import HASHED

STAGING, RECORD = "_staging-", "_decided"
FILE_FORMATS = ("parquet", "orc", "json", "csv")
# Spark removes an execution's shuffle files when it ends, not when the driver
# happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                cluster_by: Sequence[str] = (), fmt: str = "parquet",
                mode: str = "overwrite", options: dict | None = None,
                dynamic: bool = True, find_by: Sequence[str] = (),
                derive: Callable[[DataFrame], DataFrame] | None = None, dealt: bool = False) -> None:
    """Write ``df`` to ``path``.

    * ``partition_by`` -> folder partitions.  With ``dynamic`` (default) an
      overwrite replaces only the partitions present in ``df`` and leaves
      the others untouched; with ``dynamic=False`` the whole table is replaced.
      Either happens as a whole or not at all (see above).
    * ``cluster_by`` -> rows are sorted by (partition keys, cluster keys)
      inside each write task, so every file holds row groups with narrow
      key ranges (Parquet min/max statistics then skip row groups on day
      filters).
    * ``find_by`` -> columns with a Bloom filter in every Parquet row group,
      so that a filter for single values skips the groups without them,
      wherever the sort order has put them.
    * the rows are first rebalanced on the partition keys (AQE
      ``REBALANCE``): one shuffle, a partition key goes to one task unless it
      is big, and then AQE splits it into tasks of the advisory size, so a
      hot month or day does not end up in a single writer.  No sampling pass
      (range partitioning would compute its input twice).
    * ``derive`` -> a projection or filter of single rows that is applied
      after that shuffle, which then needn't carry the columns it adds. What it
      filters is still filtered first, and the partition keys must be there.
    * ``dealt`` -> the rows already lie evenly over partitions (behind a join
      or window of this plan) and are sorted where they are, without that shuffle.
    * ``fmt`` / ``options`` select the sink, so a warehouse connector is a
      matter of configuration; only Parquet is exercised here.  A sink that is
      no folder of files replaces tables in its own way.
    """
    parts = list(partition_by)
    if fmt not in FILE_FORMATS or mode != "overwrite":
        _save(df, path, parts, cluster_by, find_by, fmt, mode, options, derive, dealt)
        return
    with staging(df.sparkSession, path) as folder:
        _save(df, folder, parts, cluster_by, find_by, fmt, "errorifexists", options, derive, dealt)
        put(df.sparkSession, path, folder, depth=len(parts) if dynamic else 0)


def _save(df: DataFrame, path: str, parts: Sequence[str], cluster_by: Sequence[str] = (),
          find_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "errorifexists",
          options: dict | None = None, derive: Callable[[DataFrame], DataFrame] | None = None,
          dealt: bool = False) -> None:
    order, derive = [*parts, *cluster_by], derive or (lambda rows: rows)
    if order:
        if not dealt:
            hashed = [c for c in HASHED if c in df.columns and c not in parts]
            df = _texts(_digests(df, hashed).hint("rebalance", *parts), hashed, df.columns)
        out = derive(df).sortWithinPartitions(*order)
    else:
        out = derive(df)
    # the filter's size follows the values a row group has
    bloom = {"parquet.bloom.filter.adaptive.enabled": "true",
             **{f"parquet.bloom.filter.enabled#{c}": "true" for c in find_by}} if find_by else {}
    packed = {"compression": "zstd"} if fmt == "parquet" else {}
    w = out.write.format(fmt).mode(mode).options(**(packed | bloom | (options or {})))
    with freed_shuffles(df.sparkSession):
        (w.partitionBy(*parts) if parts else w).save(path)


def _digests(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text that is lowercase hex as its bytes, half the size, in a column
    beside it; any other text stays as it is."""
    for c in cols:
        packed = F.when(F.col(c).rlike("^([0-9a-f]{2})+$"), F.unhex(c))
        df = df.withColumn(f"__bytes_{c}", packed).withColumn(c, F.when(F.col(f"__bytes_{c}").isNull(), F.col(c)))
    return df


def _texts(df: DataFrame, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Inverse of ``_digests``, with the columns in ``order``."""
    back = {c: F.coalesce(F.lower(F.hex(f"__bytes_{c}")), F.col(c)) for c in cols}
    return df.withColumns(back).select(*order) if cols else df


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files behind."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def replace_months(df: DataFrame, path: str, months: Sequence[tuple[int, int]],
                   cluster_by: Sequence[str] = (), also_by: Sequence[str] = (),
                   find_by: Sequence[str] = (),
                   derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Replace exactly ``months`` ((year, month) pairs) of a table in folders
    of ``year`` and ``month`` (and below them ``also_by``), all of them or,
    where the job fails, none.

    ``df`` must hold rows of these months only.  A month without rows loses its
    folder, so nothing stale stays."""
    with staging(df.sparkSession, path) as folder:
        _save(df, folder, ["year", "month", *also_by], cluster_by, find_by, derive=derive)
        put(df.sparkSession, path, folder, depth=2, gone=[f"year={y}/month={m}" for y, m in set(months)])


def replace_in_two_passes(df: DataFrame, path: str, partition_by: Sequence[str], late: str,
                          settle: Callable[[DataFrame], DataFrame], cluster_by: Sequence[str] = (),
                          check: Callable[[bool], None] = lambda found: None) -> None:
    """Replace the partitions present in ``df``, of which a few rows (those
    where the boolean column ``late`` is true) need a second look at all of
    their kind: ``settle`` gets them, read back from what was written, and
    returns the rows to store.  The input is computed once.  ``check`` runs
    when the first pass is written, and is told whether it had rows; what it
    raises leaves the table as it was."""
    spark, parts = df.sparkSession, list(partition_by)
    with staging(spark, path) as folder:
        _save(df, folder, [late, *parts], cluster_by)
        check(bool(_visible(_names(spark, folder))))
        now, then = (os.path.join(folder, f"{late}={v}") for v in ("false", "true"))
        if _exists(spark, then):
            stored = df.drop(late).schema
            _save(settle(spark.read.schema(stored).parquet(then)), now, parts, cluster_by, mode="append")
        put(spark, path, folder, depth=len(parts), below=os.path.basename(now))


# ---------------------------------------------------------------- files

def _at(spark: SparkSession, path: str):
    """A Hadoop path and the file system that Spark itself uses for it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.exists(at)


def _names(spark: SparkSession, path: str) -> list[str]:
    at, fs = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _move(spark: SparkSession, source: str, target: str) -> None:
    (old, fs), (new, _) = _at(spark, source), _at(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder."""
    at, fs = _at(spark, path)
    fs.delete(at, True)


def _visible(names: list[str]) -> list[str]:
    return [n for n in names if n[0] not in "_."]


@contextmanager
def staging(spark: SparkSession, path: str) -> Iterator[str]:
    """A hidden folder of the table, for files that ``put`` moves into place.
    It goes again unless a replacement was decided."""
    finish(spark, path)
    folder = os.path.join(path, STAGING + uuid.uuid4().hex[:12])
    try:
        yield folder
    finally:
        if not _exists(spark, os.path.join(folder, RECORD)):
            delete(spark, folder)


def put(spark: SparkSession, path: str, folder: str, depth: int = 0, gone: Sequence[str] = (),
        below: str = "") -> None:
    """Decide and do the replacement: the folders ``depth`` levels deep in
    ``folder`` (in its sub-folder ``below``) take the place of their namesakes
    in the table, and those of ``gone`` go.  With depth 0 everything staged
    takes the place of everything there."""
    come = [""]
    for _ in range(max(depth, 1)):
        come = [os.path.join(c, n) for c in come
                for n in _visible(_names(spark, os.path.join(folder, below, c)))]
    if not depth:
        gone = _visible(_names(spark, path))
    record = json.dumps({"below": below, "gone": sorted({*gone, *come}), "come": come})
    at, fs = _at(spark, os.path.join(folder, RECORD + ".part"))
    out = fs.create(at, True)
    out.write(bytearray(record.encode()))
    out.close()
    _move(spark, os.path.join(folder, RECORD + ".part"), os.path.join(folder, RECORD))
    _carry_out(spark, path, folder)


def _carry_out(spark: SparkSession, path: str, folder: str) -> None:
    """Do what the folder's record says; may be repeated after a failure."""
    at, fs = _at(spark, os.path.join(folder, RECORD))
    stream = fs.open(at)
    try:
        record = json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
    come = {c: os.path.join(folder, record["below"], c) for c in record["come"]}
    for old in record["gone"]:
        # a folder that is no longer staged was moved before: the one in place is new
        if old not in come or _exists(spark, come[old]):
            delete(spark, os.path.join(path, old))
            if old in come:
                _move(spark, come[old], os.path.join(path, old))
    delete(spark, folder)


def finish(spark: SparkSession, path: str) -> None:
    """Carry out replacements of the table that were decided and cut short."""
    for name in _names(spark, path):
        folder = os.path.join(path, name)
        if name.startswith(STAGING) and _exists(spark, os.path.join(folder, RECORD)):
            _carry_out(spark, path, folder)
