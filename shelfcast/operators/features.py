"""Leakage-free lag, rolling, calendar and price features per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from shelfcast import config
from shelfcast.functions.scalars import flag, sum_of_indicators


def series_window(series: Sequence[str] = config.SERIES, day: str = "date") -> WindowSpec:
    return Window.partitionBy(*series).orderBy(day)


def lags(value: str, rows: Sequence[int], over: WindowSpec) -> list[Column]:
    return [F.lag(value, n).over(over).alias(f"lag_{n}") for n in rows]


def trailing(value: str, rows: Sequence[int], over: WindowSpec) -> list[Column]:
    """Mean and sample deviation of the n rows before the current one."""
    out = []
    for n in rows:
        frame = over.rowsBetween(-n, -1)
        out.append(F.avg(value).over(frame).alias(f"roll_mean_{n}"))
        out.append(F.stddev(value).over(frame).alias(f"roll_std_{n}"))
    return out


def trailing_full(value: str, rows: int, over: WindowSpec) -> list[Column]:
    """As ``trailing``, but NULL until the frame holds all its rows."""
    frame = over.rowsBetween(-rows, -1)
    full = F.count(value).over(frame) == rows
    return [
        F.when(full, F.avg(value).over(frame)).alias(f"roll_mean_{rows}"),
        F.when(full, F.stddev(value).over(frame)).alias(f"roll_std_{rows}"),
    ]


def leaky_mean(value: str, rows: int, over: WindowSpec) -> Column:
    """Mean that includes the current row: the counter-example, never a feature."""
    return F.avg(value).over(over.rowsBetween(-(rows - 1), 0)).alias(f"leaky_mean_{rows}")


def calendar_flags() -> list[Column]:
    return [
        flag(F.col("wday").isin(*config.WEEKEND_WDAYS)).alias("is_weekend"),
        flag(F.col("event_name_1").isNotNull()).alias("has_event"),
        sum_of_indicators(config.SNAP_COLUMNS).alias("snap_active"),
    ]


def _running(fact: DataFrame, value: str, over: WindowSpec) -> DataFrame:
    """Running count, sum and sum of squares up to and including the current row."""
    so_far = over.rowsBetween(Window.unboundedPreceding, 0)
    number = F.col(value).cast("long")
    wide = number.cast("decimal(14,0)")  # a long would overflow on sums of large squares
    return fact.select(
        "*",
        F.count(value).over(so_far).alias("_n"),
        F.coalesce(F.sum(number).over(so_far), F.lit(0)).alias("_s"),
        F.coalesce(F.sum(wide * wide).over(so_far), F.lit(0)).alias("_q"),
    )


def _trailing_from_running(rows: Sequence[int], over: WindowSpec) -> list[Column]:
    """Frame statistics as differences of running totals.

    The totals are integers, so the differences are exact, and the work per row does not
    grow with the length of the frame.
    """

    def total(name: str, back: int) -> Column:
        return F.lag(name, back, 0).over(over)

    out = []
    for n in rows:
        count = total("_n", 1) - total("_n", n + 1)
        sums = (total("_s", 1) - total("_s", n + 1)).cast("decimal(19,0)")
        squares = (total("_q", 1) - total("_q", n + 1)).cast("decimal(32,0)")
        # The difference of two large numbers: taken before anything is rounded to a double.
        spread = (count.cast("decimal(5,0)") * squares - sums * sums).cast("double") / (
            count * (count - 1)
        )
        out.append(F.when(count > 0, sums.cast("double") / count).alias(f"roll_mean_{n}"))
        out.append(F.when(count > 1, F.sqrt(spread)).alias(f"roll_std_{n}"))
    return out


def build_features(
    fact: DataFrame,
    lag_days: Sequence[int] = config.LAG_DAYS,
    windows: Sequence[int] = config.ROLL_WINDOWS,
    drop_short_history: bool = True,
    running_totals: bool | None = None,
) -> DataFrame:
    """All features in one select over one window order: one shuffle, one sort.

    Frames count rows and end one row before the current one, so nothing of the current
    day enters. On a dense panel rows are days. Rows without the longest lag are dropped
    after the window has run.

    Whole-number sales use running totals (exact, and independent of the frame length);
    any other type uses the window frames directly.
    """
    over = series_window()
    if running_totals is None:
        running_totals = isinstance(fact.schema["sales"].dataType, IntegralType)
    rows = _running(fact, "sales", over) if running_totals else fact
    rolled = (
        _trailing_from_running(windows, over)
        if running_totals
        else trailing("sales", windows, over)
    )
    price_before = F.lag("sell_price", config.PRICE_LAG_DAYS).over(over)
    features = rows.select(
        *config.HIERARCHY,
        "date",
        "sales",
        "sell_price",
        (F.col("sell_price") - price_before).alias("price_change_7d"),
        "wday",
        "month",
        "year",
        *calendar_flags(),
        *lags("sales", lag_days, over),
        *rolled,
    )
    if drop_short_history:
        features = features.where(F.col(f"lag_{max(lag_days)}").isNotNull())
    return features
