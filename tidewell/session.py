"""Session settings and the shared folder for tables a job writes along the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE splits skewed join partitions and rebalances writes; RocksDB keeps the stream's
# duplicate keys off the executor heap; batches without data would land empty folders.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidewell-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark)}/tidewell/{label}-{uuid.uuid4().hex}"


#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session does so itself.

    Spark bounds them by rows alone, so that long texts make large batches, of which a task
    holds several, in Spark's process and in Python's.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))
