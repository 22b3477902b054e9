"""Insight cards: one per flagged series, with its latest state and its persistence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions.scalars import clean_flag, fixed_text, series_key

CARD_SCHEMA = (
    "id string, item_id string, store_id string, date string, forecast double, "
    "actual_sales double, p90_forecast double, on_hand_inventory double, "
    "stockout_risk_flag int, days_flagged int, first_flagged_date string, anomaly_flag int, "
    "anomaly_score double, normalized_residual double, summary string"
)

_STATE = (
    "date",
    "forecast",
    "actual_sales",
    "p90_forecast",
    "on_hand_inventory",
    "stockout_risk_flag",
    "anomaly_flag",
    "anomaly_score",
    "normalized_residual",
)


def _number(value: str) -> Column:
    return F.coalesce(fixed_text(value), F.lit("nan"))


def summary_text() -> Column:
    """Card text. Parts that do not apply are NULL and drop out of the join of parts.

    The wording is a fixed format, the 28 days included.
    """
    opening = F.concat(
        F.lit("Item "), "item_id", F.lit(" at store "), "store_id",
        F.lit(", latest as of "), "date",
        F.lit(": forecasted demand "), _number("forecast"),
        F.lit(", actual "), _number("actual_sales"), F.lit("."),
    )
    persistence = F.when(
        F.col("days_flagged") > 1,
        F.concat(
            F.lit("flagged for "), F.col("days_flagged").cast("string"),
            F.lit(" of the last 28 days (since "), "first_flagged_date", F.lit(")"),
        ),
    ).otherwise(F.lit("flagged today"))
    risk = F.concat(
        F.lit("Stockout risk: P90 demand ("), _number("p90_forecast"),
        F.lit(") exceeds on-hand inventory ("), _number("on_hand_inventory"),
        F.lit(") — "), persistence, F.lit("."),
    )
    direction = F.when(F.col("normalized_residual") > 0, "higher").otherwise("lower")
    surprise = F.concat(
        F.lit("Anomalous demand detected — actual sales were unusually "),
        direction, F.lit(" than expected."),
    )
    return F.concat_ws(
        " ",
        opening,
        F.when(F.col("stockout_risk_flag") == 1, risk),
        F.when(F.col("anomaly_flag") == 1, surprise),
    )


def flagged_rows(scored: DataFrame) -> DataFrame:
    """Rows with either flag set; a missing flag counts as not set."""
    return scored.withColumns(
        {
            "stockout_risk_flag": clean_flag("stockout_risk_flag"),
            "anomaly_flag": clean_flag("anomaly_flag"),
        }
    ).where("stockout_risk_flag = 1 OR anomaly_flag = 1")


def latest_state(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Latest flagged row and stockout persistence per series, in one aggregation.

    The state is the maximum of a struct that starts with the date, so all its fields come
    from the same row. Every part is a mergeable maximum, count or minimum: it combines
    before the shuffle, and the same plan runs on a stream.
    """
    at_risk = F.col("stockout_risk_flag") == 1
    return (
        flagged_rows(scored)
        .groupBy(*by, *config.SERIES)
        .agg(
            F.max(F.struct(*_STATE)).alias("_state"),
            F.count_if(at_risk).cast("int").alias("days_flagged"),
            F.min(F.when(at_risk, F.col("date"))).alias("first_flagged_date"),
        )
        .select(
            *by,
            *config.SERIES,
            *(F.col(f"_state.{c}").alias(c) for c in _STATE),
            "days_flagged",
            "first_flagged_date",
        )
    )


def merge_states(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of the same series over different rows as one; parts may come in any order."""
    keys = [*by, *config.SERIES]
    return (
        parts.groupBy(*keys)
        .agg(
            F.max(F.struct(*_STATE)).alias("_state"),
            F.sum("days_flagged").cast("int").alias("days_flagged"),
            F.min("first_flagged_date").alias("first_flagged_date"),
        )
        .select(*keys, *(F.col(f"_state.{c}").alias(c) for c in _STATE), "days_flagged", "first_flagged_date")
    )


def persistence(scored: DataFrame) -> DataFrame:
    """Stockout days per series and the first of them."""
    return (
        flagged_rows(scored)
        .where("stockout_risk_flag = 1")
        .groupBy(*config.SERIES)
        .agg(F.count("date").alias("days_flagged"), F.min("date").alias("first_flagged_date"))
    )


def render_cards(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Typed card columns and the text, from the latest state."""
    typed = state.withColumns(
        {
            "id": series_key(),
            "date": F.col("date").cast("string"),
            "first_flagged_date": F.col("first_flagged_date").cast("string"),
            **{
                c: F.col(c).cast("double")
                for c in ("forecast", "actual_sales", "p90_forecast", "on_hand_inventory")
            },
        }
    )
    names = [part.split()[0] for part in CARD_SCHEMA.split(", ")]
    return typed.withColumn("summary", summary_text()).select(*by, *names)


def build_cards(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One card per flagged series (and per ``by``); empty with the same schema if none."""
    return render_cards(latest_state(scored, by), by)


def flagged_series_count(scored: DataFrame) -> DataFrame:
    pairs = flagged_rows(scored).select(*config.SERIES).distinct()
    return pairs.agg(F.count("*").alias("n_series_flagged"))
