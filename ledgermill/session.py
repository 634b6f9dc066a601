"""Session settings and the shared work folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on. Most make Spark's own defaults explicit. The skew join may add an exchange when splitting a
# hot key pays for it; a join goes on where rows lie together by a part of its key; tasks after an exchange are small,
# for a line becomes several numbers there; and small tables are small by the size of their files, which for a few columns
# of many is far below what the driver has to hold.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.autoBroadcastJoinThreshold": "2MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # parsed and rejected lines are written side by side; without this a load sorts all its lines to part them
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    # call-site capture costs several driver round trips per Column and nothing here reads it
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "ledgermill", **extra: str) -> SparkSession:
    """A session with the engine settings. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the engine settings to a session made elsewhere, as far as a running session allows."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach. Taken from the session; a temporary one only where unset."""
    context = spark.sparkContext
    configured = (spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
                  or context.getCheckpointDir())
    if configured:
        return configured
    master = context.master
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share before running on {master}")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _local_folder


_local_folder: str | None = None


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/ledgermill-{uuid.uuid4().hex[:12]}/{name}"
