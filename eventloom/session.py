"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Event time is epoch-aligned, so every session runs in UTC.  AQE coalesces small
# shuffle partitions and splits skewed join partitions, also below a later shuffle.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a Python worker gets at once is bounded in bytes, not in rows of any length.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
STREAM_CONF = {
    **BATCH_CONF,
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def build_session(app: str = "eventloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**BATCH_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the batch settings to a session made elsewhere."""
    for name, value in BATCH_CONF.items():
        spark.conf.set(name, value)
    return spark


def stream_session(spark: SparkSession) -> SparkSession:
    """A sibling session for stateful streams.

    State partitions are fixed when a stream first starts and AQE cannot merge them,
    so their number follows the cores of the cluster.
    """
    sibling = spark.newSession()
    for name, value in STREAM_CONF.items():
        sibling.conf.set(name, value)
    sibling.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return sibling


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="eventloom-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only where the session names none and runs in one process does it fall back to a local one;
    on a cluster each executor would write to its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = _local_dir()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_PARTITION = 128 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the stored size behind a frame."""
    return int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def size_shuffles(spark: SparkSession, source: DataFrame) -> None:
    """Start shuffles with one partition per 128 MB of the largest table read so far.

    AQE merges small partitions but cannot add any, so the start must fit the input; a
    fixed 200 would give partitions of hundreds of GB at 100 TB.
    """
    size = input_bytes(source)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    current = int(spark.conf.get(INITIAL_PARTITIONS, None) or least)
    wanted = size // BYTES_PER_PARTITION
    if wanted > current:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
