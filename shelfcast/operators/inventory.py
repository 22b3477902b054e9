"""On-hand inventory, stockout flags, and the supplier and cost dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions.scalars import flag, zero_floor


def days_of_cover(demand: Column, cover_days: Column, factor: Column) -> Column:
    """Stock held as days of recent demand; never negative."""
    return zero_floor(demand * cover_days * factor)


def with_inventory(
    rows: DataFrame, inputs: DataFrame, fill: Column | None = None
) -> DataFrame:
    """On-hand stock from a table of cover days and factors per series and day.

    ``fill`` replaces a missing recent mean (usually by its global median,
    see ``evaluate.median``).
    """
    demand = F.col("roll_mean_28")
    if fill is not None:
        demand = F.coalesce(demand, fill)
    joined = rows.join(inputs, list(config.SERIES_DAY), "left")
    on_hand = days_of_cover(demand, F.col("cover_days"), F.col("factor"))
    return joined.withColumn("on_hand_inventory", on_hand).drop("cover_days", "factor")


def with_stockout_flag(rows: DataFrame) -> DataFrame:
    risky = F.col("p90_forecast") > F.col("on_hand_inventory")
    return rows.withColumn("stockout_risk_flag", flag(risky))


# Allowed ranges of the dimension tables (fixed values).
SUPPLIER_RANGES = {
    "constrained": (20.0, 60.0),
    "open": (200.0, 1000.0),
    "lead_time_days": (3, 13),
}
COST_RATIO_RANGE = (0.45, 0.75)


def supplier_violations(supplier: DataFrame) -> DataFrame:
    """Items listed twice, or with values outside the allowed ranges."""
    capacity, lead = F.col("max_order_capacity"), F.col("lead_time_days")
    tight, loose = SUPPLIER_RANGES["constrained"], SUPPLIER_RANGES["open"]
    in_range = F.when(F.col("constrained"), capacity.between(*tight)).otherwise(
        capacity.between(*loose)
    ) & lead.between(*SUPPLIER_RANGES["lead_time_days"])
    return _violations(supplier, in_range)


def cost_violations(cost: DataFrame) -> DataFrame:
    return _violations(cost, F.col("cost_ratio").between(*COST_RATIO_RANGE))


def _violations(dimension: DataFrame, in_range: Column) -> DataFrame:
    return (
        dimension.groupBy("item_id")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(~F.coalesce(in_range, F.lit(False))).alias("n_out_of_range"),
        )
        .where((F.col("n_rows") > 1) | (F.col("n_out_of_range") > 0))
    )


def require_valid(violations: DataFrame, name: str) -> None:
    worst = violations.limit(5).collect()
    if worst:
        raise ValueError(f"{name}: invalid rows, for example {worst}")
