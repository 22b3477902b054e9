"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings every plan in this package is written for. They hold on a laptop and on
# a large cluster alike; the number of shuffle partitions is left to the deployment, since
# AQE only ever merges partitions downwards from it.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The dense panel is exploded from far fewer rows, so partitions that look tiny before
    # the explode must not be merged into one.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # A join on (item, store, week) may reuse rows already partitioned by (item, store).
    # Safe here because a series never holds more than one row per day.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state on local disk with checkpoints, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Settings only a new session can take: do not record the call site of every column.
_AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "shelfcast",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**_RUNTIME, **_AT_START, **(extra or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, for checkpoints and written tables.

    The deployment names it in ``spark.checkpoint.dir``, or by ``setCheckpointDir``. There is
    no fallback, on any master.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
