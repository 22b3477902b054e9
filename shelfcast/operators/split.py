"""Time-based split into training and validation rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import config


def split_cutoff(
    df: DataFrame, validation_days: int = config.VALIDATION_DAYS, last: date | None = None
) -> Column:
    """Last training day. The newest date is a scalar subquery unless it is already known."""
    newest = F.lit(last) if last else df.select(F.max("date")).scalar()
    return F.date_sub(newest, validation_days)


def time_split(
    df: DataFrame, validation_days: int = config.VALIDATION_DAYS, last: date | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cutoff, and rows after it. Never a random split."""
    cutoff = split_cutoff(df, validation_days, last)
    return df.where(F.col("date") <= cutoff), df.where(F.col("date") > cutoff)
