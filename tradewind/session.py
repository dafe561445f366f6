"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. All are runtime SQL settings, so they also apply to a session built elsewhere.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more shuffle: one key may hold a third of the fact.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

_local_dirs: dict[str, str] = {}


def build(app_name: str = "tradewind", master: str | None = None, shuffle_partitions: int | None = None,
          settings: dict[str, str] | None = None) -> SparkSession:
    """Create or reuse a session.

    ``shuffle_partitions`` is only a starting count: adaptive execution merges small partitions, so on a cluster
    it should be generous (a few per core, or input bytes / 128 MB, whichever is larger).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session that somebody else built."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    """One JVM only; ``local-cluster`` has executors of its own and counts as a cluster."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor sees, named by ``spark.checkpoint.dir``.

    Only a single-JVM session may fall back to a temporary folder; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            if not is_local(spark):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            _local_dirs[app] = tempfile.mkdtemp(prefix="tradewind-")
        root = _local_dirs[app]
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created until something is written there."""
    return f"{shared_dir(spark)}/tradewind/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex[:12]}"
