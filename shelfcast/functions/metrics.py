"""Aggregate expressions for forecast quality. Each is one partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast import config


def rmse(actual: Column, predicted: Column) -> Column:
    error = (actual - predicted).cast("double")
    return F.sqrt(F.avg(error * error))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs((actual - predicted).cast("double")))


def mape(actual: Column, predicted: Column, shift: float = config.MAPE_SHIFT) -> Column:
    """Both sides are shifted by a small value, as days without sales are common."""
    moved = actual + F.lit(shift)
    return F.avg(F.abs(moved - (predicted + F.lit(shift))) / F.abs(moved))


def pinball(actual: Column, predicted: Column, alpha: float) -> Column:
    diff = (actual - predicted).cast("double")
    return F.avg(F.greatest(F.lit(alpha) * diff, F.lit(alpha - 1.0) * diff))


def coverage(actual: Column, predicted: Column) -> Column:
    """Share of rows at or below the prediction."""
    return F.avg((actual <= predicted).cast("int"))


def rate(flag: Column) -> Column:
    return F.avg(flag)
