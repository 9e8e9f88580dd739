"""Column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def micros_between(later: str, earlier: str) -> Column:
    return F.unix_micros(F.col(later)) - F.unix_micros(F.col(earlier))


def floor_days(later: str, earlier: str) -> Column:
    """Whole days, rounded toward minus infinity (six hours early is day -1)."""
    return F.floor(micros_between(later, earlier) / F.lit(MICROS_PER_DAY)).cast("int")


def hours_between(later: str, earlier: str) -> Column:
    return micros_between(later, earlier) / F.lit(MICROS_PER_HOUR)


def to_double(name: str) -> Column:
    """Numeric value of a column; text that is no number, and NaN, become null."""
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_timestamp_or_null(name: str) -> Column:
    return F.try_to_timestamp(F.col(name).cast("string"))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value on one or both sides; null stays null."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def flag(condition: Column) -> Column:
    """0/1 flag in which an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where whole is 0 or there is nothing to count."""
    return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def existing_or_null(frame: DataFrame, name: str, kind: str = "double") -> Column:
    return F.col(name) if name in frame.columns else F.lit(None).cast(kind)


def number_or_null(frame: DataFrame, name: str) -> Column:
    """Numeric value of a column that the input may lack."""
    return to_double(name) if name in frame.columns else F.lit(None).cast("double")
