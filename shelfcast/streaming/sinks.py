"""Sources, sinks and triggers shared by the streams."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.sources import versions


def read_files(
    spark: SparkSession, path: str, schema, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of Parquet files as they arrive; the trigger size bounds files, not rows."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def append_files(stream: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    """Rows to Parquet, each exactly once: the sink keeps a log of its committed files."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )


def _query_id(spark: SparkSession) -> str:
    """The id the checkpoint gives a query, the same after a restart."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def update_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    keys: Sequence[str],
    compact_every: int = 16,
) -> StreamingQuery:
    """Changed groups of an aggregation, one folder of changes per micro-batch.

    A repeated micro-batch overwrites its own folder, so a restart leaves no duplicates. Every
    ``compact_every`` batches the changes so far are merged with the last snapshot into a new one,
    which is published as a version; :func:`current_rows` reads the newest snapshot and the
    changes after it, so a read does not grow with the number of micro-batches.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/changes/epoch={epoch}")
        if (epoch + 1) % compact_every == 0:
            compact_table(spark, path, keys, epoch, _query_id(spark))

    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def _snapshot(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """The newest snapshot and the last epoch in it; a reader stays with it."""
    version = versions.newest(spark, f"{path}/snapshots")
    if version is None:
        return None, -1
    return spark.read.parquet(f"{version.folder}/rows"), int(json.loads(version.note)["epoch"])


def _changes(spark: SparkSession, path: str, after: int, upto: int | None = None) -> DataFrame | None:
    """Changes of the epochs after a snapshot; other folders are not read."""
    try:
        rows = spark.read.option("basePath", f"{path}/changes").parquet(f"{path}/changes")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None
    rows = rows.where(F.col("epoch") > after)
    return rows if upto is None else rows.where(F.col("epoch") <= upto)


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    row = F.max_by(F.struct(*values), "epoch").alias("_row")
    return rows.groupBy(*keys).agg(row, F.max("epoch").alias("epoch")).select(*keys, "_row.*", "epoch")


def compact_table(spark: SparkSession, path: str, keys: Sequence[str], epoch: int, owner: str | None) -> None:
    """Merge the changes up to ``epoch`` into a new snapshot. Done again, it changes nothing."""
    base, last = _snapshot(spark, path)
    if last >= epoch:
        return
    rows = _changes(spark, path, last, epoch)
    merged = rows if base is None else base.unionByName(rows)
    folder = versions.draft(f"{path}/snapshots")
    _newest(merged, keys).write.parquet(f"{folder}/rows")
    versions.publish(spark, f"{path}/snapshots", folder, json.dumps({"epoch": epoch, "query": owner}))


def current_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Last version of every group of an updated table: the newest snapshot and what came after."""
    base, last = _snapshot(spark, path)
    rows = _changes(spark, path, last)
    if base is None and rows is None:
        raise FileNotFoundError(f"nothing has been written to {path}")
    every = rows if base is None else base if rows is None else base.unionByName(rows)
    return _newest(every, keys).drop("epoch")
