"""Rounding, guarded division and null ordering shared by every plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Round a double half away from zero, scaling in binary floating point.

    ``F.round`` rounds the shortest decimal text of a double instead, so the
    two differ where a value such as 1.005 is not exactly representable.
    """
    scale = float(10**digits)
    scaled = value * F.lit(scale)
    whole = F.when(value >= 0, F.floor(scaled + 0.5)).otherwise(F.ceil(scaled - 0.5))
    return whole.cast("double") / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives null for a zero divisor instead of raising."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct(numerator: Column, denominator: Column, digits: int | None = 2) -> Column:
    """``100 * numerator / denominator``, null for a zero divisor."""
    value = ratio(F.lit(100.0) * numerator.cast("double"), denominator)
    return value if digits is None else round_to(value, digits)


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it is false or unknown."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def asc(*names: str) -> list[Column]:
    """Ascending sort keys with nulls last."""
    return [F.col(name).asc_nulls_last() for name in names]


def desc(*names: str) -> list[Column]:
    """Descending sort keys with nulls last."""
    return [F.col(name).desc_nulls_last() for name in names]


def in_units(value: Column, digits: int) -> Column:
    """A value that carries ``digits`` decimals, as a whole number of its last place."""
    return round_to(value * F.lit(float(10**digits)), 0).cast("long")


def rounded_mean(units: Column, count: Column, digits: int) -> Column:
    """Mean of values given in whole units, rounded to the same number of decimals.

    Summing whole units keeps the sum exact in any order, so a mean that falls
    exactly between two roundings goes the same way on every run.
    """
    return round_to(ratio(units, count), 0) / F.lit(float(10**digits))
