"""Residual features for anomaly detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions.scalars import nan_to_null, null_or_zero_to

ANOMALY_FEATURES = ("residual", "normalized_residual", "abs_residual")


def anomaly_features(
    residuals: DataFrame,
    rows: int = config.VOLATILITY_ROWS,
    min_rows: int = config.VOLATILITY_MIN_ROWS,
    global_std: Column | None = None,
) -> DataFrame:
    """Residuals scaled by the recent volatility of their own series.

    The trailing deviation includes the current row and needs ``min_rows`` values; where
    it is missing or zero the global deviation takes its place.
    """
    clean = residuals.withColumn("residual", nan_to_null(F.col("residual").cast("double")))
    if global_std is None:
        global_std = clean.select(F.stddev("residual")).scalar()
    frame = Window.partitionBy(*config.SERIES).orderBy("date").rowsBetween(-(rows - 1), 0)
    own = F.when(F.count("residual").over(frame) >= min_rows, F.stddev("residual").over(frame))
    return (
        clean.withColumn("_own", own)
        .withColumn("resid_roll_std", null_or_zero_to("_own", global_std))
        .drop("_own")
        .withColumn("normalized_residual", F.try_divide("residual", "resid_roll_std"))
        .withColumn("abs_residual", F.abs("residual"))
    )


def threshold_flags(features: DataFrame, limit: float) -> DataFrame:
    """Flag by a fixed limit on the scaled residual; a lower score is more anomalous."""
    size = F.abs("normalized_residual")
    return features.withColumn(
        "anomaly_flag", F.when(size > limit, 1).otherwise(0)
    ).withColumn("anomaly_score", -size)


def labelled_union(parts: dict[str, DataFrame]) -> DataFrame:
    """Several residual tables as one, with the name of its part on each row."""
    tagged = [rows.withColumn("series", F.lit(name)) for name, rows in parts.items()]
    return reduce(DataFrame.unionByName, tagged)
