"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..conf import scratch_root
from ..sources.tables import load

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a test-data folder; the session's Python workers find this
    package where the driver has it.  (On a cluster whose executors don't
    share that path, submit the package with ``--py-files``.)"""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *paths]))
    return load(spark, sf_dir, name)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, every other character as it is; null stays null.

    ``lower`` equals this on pure ASCII text (one byte per character) and is
    much faster than ``translate``, so it takes that case.
    """
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and
    read back: lineage ends there and survives lost executors."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def utf8_slices(batch, rows: int = 256):
    """The texts of an Arrow string array as ``bytes`` (None for null), in
    slices, so that a batch is never held twice as Python objects."""
    import pyarrow as pa
    raw = batch.cast(pa.binary()) if not pa.types.is_large_string(batch.type) \
        else batch.cast(pa.large_binary())
    for at in range(0, len(raw), rows):
        yield raw.slice(at, rows).to_pylist()


def blocks(data: bytes, size: int, cut) -> list[bytes]:
    """``data`` in blocks of about ``size`` bytes, each ending where the
    compiled bytes pattern ``cut`` matches, so that no word is split."""
    if len(data) <= size:
        return [data]
    out, start = [], 0
    while start < len(data):
        m = cut.search(data, start + size)
        end = m.start() if m else len(data)
        out.append(data[start:end])
        start = end
    return out


_HELD: dict = {}


def held(key, build):
    """The one large object (automaton, memo) that a Python worker keeps.

    Workers outlive a query and serve the next one, so another key first lets
    go of what the last operator left."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]
