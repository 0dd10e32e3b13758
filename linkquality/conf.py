"""Session settings and the shared scratch folder.

The library never hard-codes a cluster: a caller passes its own
``SparkSession``.  ``build_session`` is what tests, ``bench.py`` and local
runs use.  Jobs that must cut lineage or write intermediate tables put them
under the folder the cluster names in ``spark.checkpoint.dir``; a private
temporary folder is created only when that setting is missing *and* the
master is local (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on.  ANSI mode stays on (Spark 4 default);
# divisions that may hit zero use ``try_divide`` instead.
SESSION_CONF = {
    # Dates are taken in the session zone (reference behaviour); fix it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sketch aggregates (medians per day and region) keep hashing up to this
    # many groups a task instead of sorting their input above 128.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    # Checkpointed frames are removed once no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, total_cores: int, split_mb: int = 256,
               shuffle_mb: int = 256) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet.

    * input splits of ``split_mb`` (100 TB -> ~400k scan tasks);
    * initial shuffle partitions so that a full-width shuffle of the input
      gives ~``shuffle_mb`` per partition, at least 2 x cores; AQE then
      coalesces small partitions and splits skewed ones to the same
      advisory size, so a partition fits an executor core's memory share.
    """
    mb = 1 << 20
    parts = max(2 * total_cores, int(input_bytes // (shuffle_mb * mb)) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{shuffle_mb}m",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": f"{shuffle_mb // 4}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * shuffle_mb}m",
    }


def build_session(master: str | None = None, app: str = "linkquality",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    and the master is local is a temporary folder created and registered
    (the situation of tests); on a cluster a missing setting is an error,
    because a machine-local folder would not survive executor loss.  Works
    without a SparkContext handle (Spark Connect sessions).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        d = d or sc.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no JVM context behind this session
        pass
    if d:
        return d.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not str(master).startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    d = tempfile.mkdtemp(prefix="linkquality-")
    if sc is not None:
        sc.setCheckpointDir(d)
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the scratch root."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
