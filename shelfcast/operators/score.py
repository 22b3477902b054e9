"""One scored row per series and day from the outputs of the three models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions.scalars import round_decimal, zero_floor

SCORED_COLUMNS = (
    *config.SERIES_DAY,
    "actual_sales",
    "forecast",
    "p90_forecast",
    "on_hand_inventory",
    "stockout_risk_flag",
    "anomaly_flag",
    "anomaly_score",
    "normalized_residual",
)


def with_forecast(rows: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Forecast clipped at zero, and the residual of the actual value."""
    return rows.withColumn("forecast", zero_floor(prediction)).withColumn(
        "residual", F.col(config.TARGET) - F.col("forecast")
    )


def merge_outputs(residuals: DataFrame, risk: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Two left joins on the series-day key; a row may lack a flag of either model.

    All three inputs share the key, so the joins need one shuffle of each input.
    """
    key = list(config.SERIES_DAY)
    return (
        residuals.select(*key, F.col(config.TARGET).alias("actual_sales"), "forecast")
        .join(
            risk.select(*key, "p90_forecast", "on_hand_inventory", "stockout_risk_flag"),
            key,
            "left",
        )
        .join(
            anomalies.select(*key, "anomaly_flag", "anomaly_score", "normalized_residual"),
            key,
            "left",
        )
        .select(*SCORED_COLUMNS)
    )


def baseline_predictions(features: DataFrame) -> DataFrame:
    """Stand-in for the learned models: recent mean, and a normal P90 around it."""
    p90 = F.col("roll_mean_28") + F.lit(1.2816) * F.col("roll_std_28")
    return features.select(
        "*",
        round_decimal("roll_mean_7", 6).alias("forecast"),
        round_decimal(p90, 6).alias("p90_forecast"),
        round_decimal(F.col("sales") - F.col("roll_mean_7"), 6).alias("residual"),
    )
