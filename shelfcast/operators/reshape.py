"""Wide to long, long to wide, and filling the gaps of a sparse daily panel."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config

# Up to this many day columns the built-in unpivot compiles to one generated method.
# Wider tables go through one array column, which stays compact at thousands of days.
_EXPAND_LIMIT = 64


def day_columns(wide: DataFrame, prefix: str = config.DAY_PREFIX) -> list[str]:
    """Day columns, discovered by their prefix."""
    return [c for c in wide.columns if c.startswith(prefix)]


def melt(
    wide: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name: str = "d",
    value: str = "sales",
) -> DataFrame:
    """Wide to long, one row per id and value column; nulls are kept."""
    if len(values) <= _EXPAND_LIMIT:
        return wide.unpivot(list(ids), list(values), name, value)
    # One SQL text instead of thousands of column objects, each of which is a driver call.
    cells = ", ".join(f"`{c}`" for c in values)
    labels = ", ".join(_sql_text(c) for c in values)
    return wide.selectExpr(*_quoted(ids), f"posexplode(array({cells})) AS (_at, {value})").select(
        *ids, F.get(F.expr(f"array({labels})"), F.col("_at")).alias(name), value
    )


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in names]


def _sql_text(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def unpivot_days(
    wide: DataFrame,
    ids: Sequence[str] = ("id", *config.HIERARCHY),
    prefix: str = config.DAY_PREFIX,
) -> DataFrame:
    """Wide sales to one row per series and day. Days without a value give no row."""
    return melt(wide, ids, day_columns(wide, prefix)).where(F.col("sales").isNotNull())


def pivot_days(
    long: DataFrame, ids: Sequence[str], days: Sequence[str], value: str = "sales"
) -> DataFrame:
    """Long to wide over a known list of day labels: one shuffle on the ids."""
    return long.groupBy(*ids).pivot("d", list(days)).agg(F.sum(value))


def densify(
    sparse: DataFrame,
    zero_fill: Sequence[str] = ("sales",),
    keep: Sequence[str] = config.HIERARCHY,
    series: Sequence[str] = config.SERIES,
    day: str = "date",
    first: date | None = None,
    last: date | None = None,
    since: date | None = None,
    period: Callable[[Column], Column] | None = None,
    period_values: Sequence[str] = (),
) -> DataFrame:
    """One row per series and calendar day, with zeros on the days that had no row.

    Every observed row covers the days up to the next one of its series, so the gaps are
    filled by exploding rows where they lie. The sparse rows are shuffled once by series;
    the (much larger) dense panel is never shuffled, and later windows over the same
    series reuse the partitioning. Rows must be unique per series and day, which also
    bounds a series by the length of the calendar.

    ``period_values`` are constant within a period (say, a weekly price): a filled day
    takes them from an observed row of its period, on either side, and else has NULL.

    ``since`` gives only the days from then on; earlier days are never exploded.
    """
    low = F.lit(first) if first else sparse.select(F.min(day)).scalar()
    high = F.lit(last) if last else sparse.select(F.max(day)).scalar()
    along = Window.partitionBy(*series).orderBy(day)
    spans = sparse.select(
        *keep,
        F.col(day).alias("_seen"),
        F.lead(day).over(along).alias("_next"),
        *zero_fill,
        *period_values,
        *(F.lead(c).over(along).alias(f"_next_{c}") for c in period_values),
        F.when(F.lag(day).over(along).isNull(), low).otherwise(F.col(day)).alias("_from"),
    )
    spans = spans.withColumn("_until", F.coalesce(F.date_sub("_next", 1), high))
    if since:
        spans = spans.where(F.col("_until") >= F.lit(since)).withColumn(
            "_from", F.greatest("_from", F.lit(since))
        )
    exploded = spans.select(
        "*", F.explode(F.sequence("_from", "_until", F.expr("interval 1 day"))).alias(day)
    )

    def filled(column: str) -> Column:
        kind = sparse.schema[column].dataType
        seen = F.col(day) == F.col("_seen")
        return F.when(seen, F.col(column)).otherwise(F.lit(0).cast(kind)).alias(column)

    def carried(column: str) -> Column:
        here = period(F.col(day))
        return (
            F.when(here == period(F.col("_seen")), F.col(column))
            .when(here == period(F.col("_next")), F.col(f"_next_{column}"))
            .alias(column)
        )

    return exploded.select(
        *keep, day, *(filled(c) for c in zero_fill), *(carried(c) for c in period_values)
    )
