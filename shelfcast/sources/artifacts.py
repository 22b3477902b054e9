"""Run metrics, saved models and artifact copies, as tables and paths or URIs."""

from __future__ import annotations

from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.tables import append_table, read_parquet, write_table

METRIC_SCHEMA = (
    "run string, model string, kind string, name string, value string, logged_at timestamp"
)


def metric_rows(metrics: DataFrame, run: str, model: str, logged_at: Column) -> DataFrame:
    """A one-row metrics table as one row per metric."""
    texts = metrics.select(*(F.col(c).cast("string").alias(c) for c in metrics.columns))
    return texts.unpivot([], metrics.columns, "name", "value").select(
        F.lit(run).alias("run"),
        F.lit(model).alias("model"),
        F.lit("metric").alias("kind"),
        "name",
        "value",
        logged_at.alias("logged_at"),
    )


def param_rows(
    spark: SparkSession, params: dict, run: str, model: str, logged_at: Column
) -> DataFrame:
    rows = [(run, model, "param", name, str(value)) for name, value in params.items()]
    schema = "run string, model string, kind string, name string, value string"
    return spark.createDataFrame(rows, schema).withColumn("logged_at", logged_at)


def log_run(rows: DataFrame, path: str) -> None:
    append_table(rows, path)


def save_model(model: MLWritable, folder: str, name: str) -> str:
    """Save under a name, replacing the earlier version."""
    path = f"{folder.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(kind: type[MLReadable], folder: str, name: str):
    return kind.load(f"{folder.rstrip('/')}/{name}")


def publish_tables(spark: SparkSession, tables: dict[str, str], target: str) -> None:
    """Copy Parquet tables to another store; both sides are any URI Spark can reach."""
    for name, source in tables.items():
        write_table(read_parquet(spark, source, name), f"{target.rstrip('/')}/{name}")
