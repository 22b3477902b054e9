"""Sales, calendar and price tables derived from an order-line star schema.

Items and stores come from the parts and suppliers of order lines; see FIXTURES.md.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.scalars import round_decimal
from shelfcast.operators import panel, reshape
from shelfcast.sources.tables import read_table


@dataclass(frozen=True)
class Span:
    """First and last day of the panel."""

    first: date
    last: date

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1


# The columns read, with their types, so that no footer has to be read for a schema.
_COLUMNS = {
    "lineitem": (
        "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_shipdate timestamp_ntz"
    ),
    "part": "p_partkey long, p_brand string, p_type string",
    "supplier": "s_suppkey long, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def span_of(spark: SparkSession, folder: str) -> Span:
    """First and last ship day: one partial aggregate over one pruned column."""
    low, high = (
        read_table(spark, folder, "lineitem", "l_shipdate timestamp_ntz")
        .agg(F.min("l_shipdate").cast("date"), F.max("l_shipdate").cast("date"))
        .first()
    )
    return Span(low, high)


# Source columns of item, store and state per grain.
_GRAINS = {"fine": ("p_brand", "n_name", "r_name"), "coarse": ("p_type", "r_name", "r_name")}


def _hierarchy(grain: str) -> list[Column]:
    """Item, department, category, store and state from the source columns."""
    item, store, state = _GRAINS[grain]
    number = F.substring(item, 7, 9).cast("int") % 7 if grain == "fine" else F.lit(0)
    category = number % 3
    return [
        F.col(item).alias("item_id"),
        F.concat(F.lit("DEPT_"), number.cast("string")).alias("dept_id"),
        F.concat(F.lit("CAT_"), category.cast("string")).alias("cat_id"),
        F.col(store).alias("store_id"),
        F.col(state).alias("state_id"),
    ]


def daily_sales(spark: SparkSession, folder: str, grain: str = "fine") -> DataFrame:
    """Units and revenue (in cents) per item, store and day that had sales.

    The joins form a chain on base tables, whose sizes the optimizer knows: the small ones
    broadcast, the others shuffle with AQE splitting skewed parts. The aggregation
    combines before it shuffles, so a hot item arrives as at most one row per store and
    day from each task. Derived ids are built after it, on far fewer rows.
    """
    source = {name: read_table(spark, folder, name, schema) for name, schema in _COLUMNS.items()}
    sold = (
        source["lineitem"]
        .join(source["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(source["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(source["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(source["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    by_key = sold.groupBy(
        *dict.fromkeys(_GRAINS[grain]), F.col("l_shipdate").cast("date").alias("date")
    ).agg(F.sum("l_quantity").cast("long").alias("sales"), F.sum(cents).alias("cents"))
    return by_key.select(*_hierarchy(grain), "date", "sales", "cents")


def day_label(day: Column, first: date) -> Column:
    return F.concat(F.lit("d_"), (F.datediff(day, F.lit(first)) + 1).cast("string"))


def calendar(spark: SparkSession, span: Span) -> DataFrame:
    """One row per day of the span. Built from a range, so its size is known."""
    index = F.col("id")
    day = F.date_add(F.lit(span.first), index.cast("int"))
    month, dom = F.month(day), F.dayofmonth(day)
    event = F.when((month == 12) & (dom == 25), "EventA").when((month == 7) & (dom == 4), "EventB")
    return spark.range(span.days).select(
        day.alias("date"),
        (F.floor(index / 7) + 1).cast("long").alias("wm_yr_wk"),
        F.date_format(day, "EEEE").alias("weekday"),
        F.dayofweek(day).cast("long").alias("wday"),
        month.cast("long").alias("month"),
        F.year(day).cast("long").alias("year"),
        F.concat(F.lit("d_"), (index + 1).cast("string")).alias("d"),
        event.alias("event_name_1"),
        F.when(event.isNotNull(), "Cultural").alias("event_type_1"),
        (dom <= 10).cast("long").alias("snap_ca"),
        ((dom <= 15) & (dom % 2 == 1)).cast("long").alias("snap_tx"),
        dom.isin(2, 3, 5, 6, 8, 9, 11, 12, 14, 15).cast("long").alias("snap_wi"),
    )


def week_of(day: Column, first: date) -> Column:
    return (F.floor(F.datediff(day, F.lit(first)) / 7) + 1).cast("long")


def weekly_prices(daily: DataFrame, span: Span) -> DataFrame:
    """Mean unit price per item, store and week with sales."""
    return daily.groupBy(
        "item_id", "store_id", week_of(F.col("date"), span.first).alias("wm_yr_wk")
    ).agg((F.sum("cents") / F.lit(100.0) / F.sum("sales")).alias("sell_price"))


def sales_long(daily: DataFrame, span: Span) -> DataFrame:
    """Dense long sales with the day label, as the wide table would give them."""
    dense = reshape.densify(daily, first=span.first, last=span.last)
    return dense.withColumn("d", day_label(F.col("date"), span.first))


def priced_long(daily: DataFrame, span: Span, since: date | None = None) -> DataFrame:
    """Dense long sales with the weekly price, from one pass over the daily rows.

    Gives the same rows as joining ``weekly_prices``, but the order lines are read and
    joined once instead of twice.
    """

    def week(day: Column) -> Column:
        return week_of(day, span.first)

    # Peers of the week inside the series partition: the same shuffle as the gap filling.
    same_week = (
        Window.partitionBy("item_id", "store_id")
        .orderBy(week(F.col("date")))
        .rangeBetween(Window.currentRow, Window.currentRow)
    )
    revenue = F.sum("cents").over(same_week) / F.lit(100.0)
    priced = daily.withColumn("sell_price", revenue / F.sum("sales").over(same_week))
    dense = reshape.densify(
        priced,
        first=span.first,
        last=span.last,
        since=since,
        period=week,
        period_values=["sell_price"],
    )
    return dense.withColumn("d", day_label(F.col("date"), span.first))


def fact_table(
    spark: SparkSession, folder: str, grain: str = "fine", since: date | None = None
) -> DataFrame:
    """Dense fact panel. ``since`` keeps only the days a later scoring step depends on."""
    span = span_of(spark, folder)
    long = priced_long(daily_sales(spark, folder, grain), span, since)
    days = panel.with_calendar(long, calendar(spark, span))
    return days.select(*panel.FACT_COLUMNS)


def uniform(seed: int, tag: str, *key: Column | str) -> Column:
    """Number in [0, 1) from a hash of the key; does not depend on row order."""
    text = F.concat_ws("|", *key, F.lit(str(seed)), F.lit(tag))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def normal(seed: int, tag: str, *key: Column | str) -> Column:
    """Standard normal value from two hashed uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(seed, f"{tag}1", *key)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(seed, f"{tag}2", *key))


def cover_columns(seed: int = 42) -> tuple[Column, Column]:
    """Stand-in for an inventory table: days of cover and a factor around 1."""
    key = [F.col("item_id"), F.col("store_id"), F.col("date").cast("string")]
    cover = F.lit(5.0) + F.lit(7.0) * uniform(seed, "cover", *key)
    spread = F.lit(1.0) + F.lit(0.15) * normal(seed, "noise", *key)
    return cover.alias("cover_days"), F.greatest(F.lit(0.0), spread).alias("factor")


def _items(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part", "p_brand string")
    return parts.select(F.col("p_brand").alias("item_id")).distinct()


def supplier_dimension(spark: SparkSession, folder: str, seed: int = 7) -> DataFrame:
    """Stand-in supplier table: one row per item with capacity and lead time."""
    items = _items(spark, folder)
    constrained = uniform(seed, "constrained", "item_id") < 0.10
    share = uniform(seed, "capacity", "item_id")
    capacity = F.when(constrained, 20.0 + 40.0 * share).otherwise(200.0 + 800.0 * share)
    return items.select(
        "item_id",
        round_decimal(capacity, 1).alias("max_order_capacity"),
        (F.floor(11 * uniform(seed, "lead", "item_id")) + 3).cast("int").alias("lead_time_days"),
        constrained.alias("constrained"),
    )


def cost_dimension(spark: SparkSession, folder: str, seed: int = 7) -> DataFrame:
    items = _items(spark, folder)
    ratio = F.lit(0.45) + F.lit(0.30) * uniform(seed, "cost", "item_id")
    return items.select("item_id", round_decimal(ratio, 3).alias("cost_ratio"))
