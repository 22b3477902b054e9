"""Replay of scored days in batches of consecutive dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators import cards, decisions


def with_batch(scored: DataFrame, batch_days: int = 1) -> DataFrame:
    """Number of the batch a row's date falls in, over the sorted distinct dates.

    The ranking runs over the distinct dates only, so its one partition holds a calendar.
    """
    ranked = (
        scored.select("date")
        .distinct()
        .select("date", (F.row_number().over(Window.orderBy("date")) - 1).alias("_r"))
    )
    batches = ranked.select(
        F.col("date").alias("_date"), F.floor(F.col("_r") / batch_days).cast("int").alias("batch")
    )
    return scored.join(batches, F.col("date") == F.col("_date")).drop("_date")


def batch_cards(
    scored: DataFrame, batch_days: int = 1, max_batches: int | None = None
) -> DataFrame:
    """Cards of all batches in one plan; every batch is seen alone."""
    batched = with_batch(scored, batch_days)
    if max_batches:
        batched = batched.where(F.col("batch") < max_batches)
    return cards.build_cards(batched, ["batch"])


def batch_report(built: DataFrame) -> DataFrame:
    """Per batch: cards, cards published as stockout risk, and positive reorders."""
    quantity = decisions.reorder_quantity(F.col("p90_forecast"), F.col("on_hand_inventory"))
    at_risk = F.col("stockout_risk_flag") == 1
    return built.groupBy("batch").agg(
        F.count("*").alias("cards"),
        F.count_if(at_risk).alias("published"),
        F.count_if(at_risk & (quantity > 0)).alias("reorders"),
    )
