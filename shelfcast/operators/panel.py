"""The fact table: long sales joined with the calendar and the weekly prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast import config

FACT_COLUMNS = (
    *config.HIERARCHY,
    "date",
    "wm_yr_wk",
    "weekday",
    "wday",
    "month",
    "year",
    "event_name_1",
    "event_type_1",
    *config.SNAP_COLUMNS,
    "sales",
    "sell_price",
)


def with_calendar(long: DataFrame, calendar: DataFrame) -> DataFrame:
    """Inner join on the day label. The calendar has one row per day, so its size is known
    to the optimizer and it is broadcast by size, not by a hint."""
    days = calendar.withColumn("date", F.col("date").cast("date"))
    drop = [c for c in ("date",) if c in long.columns]
    return long.drop(*drop).join(days, "d")


def with_prices(days: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join of the weekly price; a week without a price keeps its sales."""
    return days.join(
        prices.select("item_id", "store_id", "wm_yr_wk", "sell_price"),
        ["item_id", "store_id", "wm_yr_wk"],
        "left",
    )


def build_fact(long: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    return with_prices(with_calendar(long, calendar), prices).select(*FACT_COLUMNS)


def fact_counts(fact: DataFrame) -> DataFrame:
    """Rows and distinct series. The pair is counted as a pair, not as joined text."""
    return fact.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(*config.SERIES).alias("n_series"),
    )


def series_coverage(fact: DataFrame) -> DataFrame:
    """Number of series and mean rows per series, by a two-level aggregate."""
    per_series = fact.groupBy(*config.SERIES).agg(F.count("*").alias("n"))
    return per_series.agg(
        F.count("*").alias("n_series"), F.avg("n").alias("avg_rows_per_series")
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First rows in a given order; each task passes on at most n rows."""
    return df.orderBy(*order).limit(n)


def first_series(fact: DataFrame, n: int) -> DataFrame:
    """All rows of the first n series. The key set has at most n rows."""
    keys = first_rows(fact.select(*config.SERIES).distinct(), config.SERIES, n)
    return fact.join(keys, list(config.SERIES), "left_semi")
