"""Scalar column functions used across the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast import config


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_decimal(value: Column | str, places: int) -> Column:
    """Round half-up on the decimal value, so that ties do not depend on binary noise."""
    return F.round(_col(value).cast("decimal(38,6)"), places).cast("double")


def fixed_text(value: Column | str, places: int = 1) -> Column:
    """Text with a fixed number of decimals; NULL stays NULL."""
    rounded = F.round(_col(value).cast("decimal(38,6)"), places)
    return rounded.cast(f"decimal(38,{places})").cast("string")


def zero_floor(value: Column | str) -> Column:
    """Clip below at zero. ``greatest`` alone would turn NULL into 0."""
    value = _col(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), value))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def clean_flag(value: Column | str) -> Column:
    """A nullable flag as a plain 0/1 integer."""
    return F.coalesce(_col(value), F.lit(0)).cast("int")


def null_or_zero_to(value: Column | str, fallback: Column) -> Column:
    """NULL and zero both give way to the fallback."""
    return F.coalesce(F.nullif(_col(value), F.lit(0.0)), fallback)


def sum_of_indicators(columns: Iterable[str]) -> Column:
    """Row-wise sum in which a missing indicator counts as zero."""
    terms = [F.coalesce(F.col(c), F.lit(0)) for c in columns]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def nan_to_null(value: Column | str) -> Column:
    """NaN compares as the largest number in Spark, so drop it at the boundary."""
    value = _col(value)
    return F.when(~F.isnan(value), value)


def series_key(*columns: str) -> Column:
    return F.concat_ws("_", *(columns or config.SERIES))


def step(value: Column, steps: Iterable[tuple[float, float]], otherwise: float) -> Column:
    """Step function: the first threshold reached decides the result."""
    (at, result), *rest = steps
    out = F.when(value >= at, F.lit(result))
    for at, result in rest:
        out = out.when(value >= at, F.lit(result))
    return out.otherwise(F.lit(otherwise))


def json_field(payload: Column | str, name: str, kind: str, default=None) -> Column:
    """One field of a JSON text, typed, with a default when it is missing."""
    value = F.get_json_object(_col(payload), f"$.{name}").cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default))


def in_list(column: Column | str, allowed: Iterable) -> Column:
    """IN-list test in which an empty list keeps every row."""
    allowed = list(allowed)
    return _col(column).isin(allowed) if allowed else F.lit(True)


def before(moment: Column, seconds: int) -> Column:
    """A point in time some seconds earlier. ``moment`` is passed in, so results repeat."""
    return moment - F.make_dt_interval(secs=F.lit(seconds))
