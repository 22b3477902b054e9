"""Table reads and writes. Locations are paths or URIs; Spark resolves the scheme."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import config
from shelfcast.session import scratch_path


class MissingInput(FileNotFoundError):
    """An input table is not there; the message names the table and the path."""


def _guard(read, name: str, path: str, hint: str = "") -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        tail = f" {hint}" if hint else ""
        raise MissingInput(f"Table '{name}' not found at {path}.{tail}") from error


def read_parquet(
    spark: SparkSession, path: str, name: str | None = None, schema: str | None = None, hint=""
) -> DataFrame:
    """Parquet table. A given schema saves reading footers and limits the columns."""
    reader = spark.read.schema(schema) if schema else spark.read
    return _guard(lambda: reader.parquet(path), name or path, path, hint)


def read_table(
    spark: SparkSession, folder: str, name: str, schema: str | None = None
) -> DataFrame:
    """One of the Parquet tables of a folder."""
    return read_parquet(spark, f"{folder.rstrip('/')}/{name}.parquet", name, schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    For rows that several later steps read: they are computed once, the plan stays short,
    and a lost executor does not lose them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_csv(
    spark: SparkSession, path: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred by a pass over the file."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return _guard(lambda: reader.csv(path), name, path)


def wide_sales_schema(columns: Sequence[str], prefix: str = config.DAY_PREFIX) -> T.StructType:
    """Day columns are integers, all others text."""
    return T.StructType(
        [
            T.StructField(c, T.LongType() if c.startswith(prefix) else T.StringType())
            for c in columns
        ]
    )


def read_wide_sales(spark: SparkSession, path: str) -> DataFrame:
    """Wide sales CSV: the schema comes from the header line, with no pass over the data."""
    header = _guard(lambda: spark.read.option("header", True).csv(path), "raw_sales", path)
    return spark.read.option("header", True).schema(wide_sales_schema(header.columns)).csv(path)


CALENDAR_SCHEMA = (
    "date date, wm_yr_wk long, weekday string, wday long, month long, year long, d string, "
    "event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string, "
    "snap_ca long, snap_tx long, snap_wi long"
)
PRICES_SCHEMA = "store_id string, item_id string, wm_yr_wk long, sell_price double"


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar CSV; columns are matched by name, whatever their letter case."""
    raw = _guard(lambda: spark.read.option("header", True).csv(path), "calendar", path)
    known = {f.name: f.dataType for f in T._parse_datatype_string(CALENDAR_SCHEMA).fields}
    return raw.select(
        *(
            F.col(f"`{c}`").cast(known.get(c.lower(), T.StringType())).alias(c.lower())
            for c in raw.columns
        )
    )


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    raw = _guard(lambda: spark.read.option("header", True).csv(path), "prices", path)
    known = {f.name: f.dataType for f in T._parse_datatype_string(PRICES_SCHEMA).fields}
    return raw.select(
        *(F.col(c).cast(known.get(c, T.StringType())).alias(c) for c in raw.columns)
    )


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> None:
    """Create or replace a Parquet table; optional order inside each file."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json_lines(spark: SparkSession, path: str, schema, name: str) -> DataFrame:
    return _guard(lambda: spark.read.schema(schema).json(path), name, path)
