"""Reporting queries over the scored table, the cards and the action log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions.scalars import in_list, json_field
from shelfcast.operators import topics

# Fixed format: the columns a consumer of the feed reads.
FEED_COLUMNS = (
    "id",
    "item_id",
    "store_id",
    "date",
    "forecast",
    "actual_sales",
    "stockout_risk_flag",
    "anomaly_flag",
    "summary",
)
NO_RATIONALE = "(no reason given)"


def kpi(scored: DataFrame, cards: DataFrame) -> DataFrame:
    n_cards = cards.select(F.count("*")).scalar()
    return scored.agg(
        F.count("*").alias("rows_scored"),
        F.avg("stockout_risk_flag").alias("stockout_rate"),
        F.avg("anomaly_flag").alias("anomaly_rate"),
        F.first(n_cards).alias("n_cards"),
    )


def series_list(scored: DataFrame) -> DataFrame:
    return scored.select(*config.SERIES).distinct()


def default_series(scored: DataFrame) -> DataFrame:
    """The first series at risk; without any, the first series."""
    pair = F.struct(*config.SERIES)
    risky = F.min(F.when(F.col("stockout_risk_flag") == 1, pair))
    return scored.agg(F.coalesce(risky, F.min(pair)).alias("_s")).select("_s.*")


def series_slice(scored: DataFrame, item_id: Column | str, store_id: Column | str) -> DataFrame:
    """One series in date order."""
    return (
        scored.where((F.col("item_id") == item_id) & (F.col("store_id") == store_id))
        .select("date", "actual_sales", "forecast", "p90_forecast")
        .orderBy("date")
    )


def card_feed(cards: DataFrame, stores: Sequence[str] = ()) -> DataFrame:
    return cards.where(in_list("store_id", stores)).select(*FEED_COLUMNS)


def recent_actions(
    actions: DataFrame, limit: int = 50, lifted: str = "reorder_recommended"
) -> DataFrame:
    """Newest actions, with the reorder fields lifted out of their JSON details."""
    wanted = F.col("action") == lifted

    def lift(name: str, kind: str):
        return F.when(wanted, json_field("details", name, kind)).alias(name)

    return topics.recent(actions, limit).select(
        F.col("created_at").alias("time"),
        "agent",
        "action",
        "card_id",
        lift("item_id", "string"),
        lift("store_id", "string"),
        lift("reorder_qty", "double"),
    )


def rationale_of(actions: DataFrame, card_id: Column | str) -> DataFrame:
    return actions.where(
        (F.col("action") == "reorder_recommended") & (F.col("card_id") == card_id)
    ).select(
        "card_id", json_field("details", "rationale", "string", NO_RATIONALE).alias("rationale")
    )


def chain_report(
    queue: DataFrame, consumed: DataFrame, actions: DataFrame, limit: int = 15
) -> tuple[DataFrame, DataFrame]:
    """Backlog per topic and the latest actions after a run."""
    latest = topics.recent(actions, limit).select("created_at", "agent", "action", "card_id")
    return topics.backlog(queue, consumed), latest
