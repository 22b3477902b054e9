"""Forecast quality, distribution summaries and calibration."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions import metrics


def point_metrics(scored: DataFrame, actual="actual_sales", predicted="forecast") -> DataFrame:
    y, p = F.col(actual), F.col(predicted)
    return scored.agg(
        metrics.rmse(y, p).alias("rmse"),
        metrics.mae(y, p).alias("mae"),
        metrics.mape(y, p).alias("mape"),
    )


def risk_metrics(
    scored: DataFrame,
    alpha: float = config.RISK_QUANTILE,
    actual="actual_sales",
    predicted="p90_forecast",
) -> DataFrame:
    y, p = F.col(actual), F.col(predicted)
    return scored.agg(
        metrics.pinball(y, p, alpha).alias("pinball_loss"),
        metrics.coverage(y, p).alias("p90_coverage"),
        metrics.rate(F.col("stockout_risk_flag")).alias("flagged_stockout_rate"),
    )


def flag_rates(scored: DataFrame) -> DataFrame:
    return scored.agg(
        metrics.rate(F.col("stockout_risk_flag")).alias("stockout_rate"),
        metrics.rate(F.col("anomaly_flag")).alias("anomaly_rate"),
    )


@dataclass(frozen=True)
class _Bracket:
    """Where a rank is known to be: values from ``low`` to ``high``, ``rows`` of them, after ``below``."""

    low: float
    high: float
    below: int
    rows: int

    def holds(self, value: Column) -> Column:
        return (value >= self.low) & (value <= self.high)

    def narrowed(self, rank: int, sides: tuple[float, float], counts: Sequence[int]) -> _Bracket:
        """The part that holds the rank: a side itself, between the sides, or beyond one of them.

        ``counts`` are the bracket's rows below and up to the first side, and the second.
        """
        place = rank - self.below
        start, end = sides
        under, upto_start, before_end, upto_end = counts
        if place < under:
            return _Bracket(self.low, math.nextafter(start, -math.inf), self.below, under)
        if place < upto_start:
            return _Bracket(start, start, self.below + under, upto_start - under)
        if place < before_end:
            inner = math.nextafter(start, math.inf), math.nextafter(end, -math.inf)
            return _Bracket(*inner, self.below + upto_start, before_end - upto_start)
        if place < upto_end:
            return _Bracket(end, end, self.below + before_end, upto_end - before_end)
        return _Bracket(math.nextafter(end, math.inf), self.high, self.below + upto_end, self.rows - upto_end)


def order_statistics(
    df: DataFrame, value: str, ranks: Sequence[int], small: int = 50_000, accuracy: int = 10_000
) -> list[float]:
    """The values at given ranks (from 0) of all values in order, exactly.

    Searched in rounds: a mergeable summary of bounded size gives a bracket around each rank, a
    count of the rows below and inside confirms it, and the next round looks inside only. Each
    round narrows a bracket to some ten-thousandths of its rows, until it is one value or holds
    at most ``small`` rows, which are then sorted. So no buffer grows with the data, and what
    reaches the driver is a few numbers a round. ``df`` is read twice a round: pass stored rows.
    """
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull()).select(x.alias("x"))
    x = F.col("x")
    total, low, high = rows.agg(F.count("*"), F.min("x"), F.max("x")).first()
    wanted = sorted(set(ranks))
    brackets = {k: _Bracket(low, high, 0, total) for k in wanted}
    while True:
        left = [k for k, b in brackets.items() if b.rows > small and b.low < b.high]
        if not left:
            break
        near = {}
        for k in left:
            b = brackets[k]
            share, slack = (k - b.below + 0.5) / b.rows, 2 / accuracy
            at = [max(0.0, share - slack), min(1.0, share + slack)]
            near[k] = F.percentile_approx(F.when(b.holds(x), x), at, accuracy)
        guesses = rows.agg(*(near[k].alias(str(k)) for k in left)).first()
        sides = {k: tuple(guesses[str(k)]) for k in left}
        counts = rows.agg(*(
            F.array(*(
                F.count_if(brackets[k].holds(x) & side)
                for side in (x < sides[k][0], x <= sides[k][0], x < sides[k][1], x <= sides[k][1])
            )).alias(str(k)) for k in left
        )).first()
        for k in left:
            brackets[k] = brackets[k].narrowed(k, sides[k], counts[str(k)])
    open_ = {k: b for k, b in brackets.items() if b.low < b.high}
    found = {k: b.low for k, b in brackets.items() if k not in open_}
    if open_:
        inside = (F.sort_array(F.collect_list(F.when(b.holds(x), x)))[k - b.below].alias(str(k)) for k, b in open_.items())
        found |= {int(k): v for k, v in rows.agg(*inside).first().asDict().items()}
    return [found[k] for k in ranks]


def percentiles(df: DataFrame, value: str, shares: Sequence[float]) -> list[float | None]:
    """Exact percentiles with linear interpolation; None where there are no values."""
    total = df.where(F.col(value).isNotNull()).count()
    if not total:
        return [None] * len(shares)
    # Places in hundred-millionths of a rank, so that 0.6 of 10 steps is 6 and not 5.999...
    places = [round(q * (total - 1), 8) for q in shares]
    ranks = [r for p in places for r in (math.floor(p), math.ceil(p))]
    values = order_statistics(df, value, ranks)
    pairs = zip(places, values[::2], values[1::2])
    return [low + (high - low) * (place - math.floor(place)) for place, low, high in pairs]


def median(df: DataFrame, value: str) -> Column:
    """Exact global median, for use in a query."""
    return F.lit(percentiles(df, value, [0.5])[0]).cast("double")


def calibration(
    df: DataFrame, value: str, shares: Sequence[float] = (0.6, 0.9, 0.99)
) -> DataFrame:
    """For each candidate quantile: its level and the share of rows at or below it."""
    x = F.col(value).cast("double")
    entries = F.array(*(
        F.struct(
            F.lit(float(q)).alias("quantile"),
            F.lit(level).cast("double").alias("level"),
            (F.count_if(x <= level) / F.count(x) if level is not None else F.lit(None).cast("double")).alias("coverage"),
        )
        for q, level in zip(shares, percentiles(df, value, shares))
    ))
    return df.agg(entries.alias("_e")).select(F.inline("_e"))


def share_above_mean(df: DataFrame, value: str) -> DataFrame:
    mean = df.select(F.avg(value)).scalar()
    return df.agg(F.avg((F.col(value) > mean).cast("int")).alias("share_above_mean"))


def histogram(df: DataFrame, value: str, bins: int = config.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum; empty bins are listed with 0.

    The maximum belongs to the last bin. If all values are equal they fall in the middle.
    """
    x = F.col(value).cast("double")
    low, high = df.select(F.min(x)).scalar(), df.select(F.max(x)).scalar()
    raw = F.width_bucket(x, low, high, F.lit(bins))
    bucket = F.coalesce(F.least(raw, F.lit(bins)), F.lit(bins // 2 + 1)).cast("long")
    counted = (
        df.where(x.isNotNull()).groupBy(bucket.alias("bin")).agg(F.count("*").alias("n"))
    )
    spark = df.sparkSession
    return (
        spark.range(1, bins + 1)
        .withColumnRenamed("id", "bin")
        .join(counted, "bin", "left")
        .select("bin", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    )
