"""Columns that turn codes and numbers into labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.fixed_values import SEASON_MONTHS


def label_of(column: str, names: dict, default: str | None = None) -> Column:
    """The name for each code; ``default`` (or null) for any other value."""
    chosen = None
    for code, name in names.items():
        hit = F.col(column) == F.lit(code)
        chosen = F.when(hit, F.lit(name)) if chosen is None else chosen.when(hit, F.lit(name))
    return chosen.otherwise(F.lit(default))


def bucket_of(column: str, buckets: list[tuple[float | None, str]]) -> Column:
    """The first bucket whose inclusive upper bound holds the value."""
    *bounded, (_, last) = buckets
    chosen = None
    for upper, name in bounded:
        hit = F.col(column) <= F.lit(float(upper))
        chosen = F.when(hit, F.lit(name)) if chosen is None else chosen.when(hit, F.lit(name))
    return chosen.otherwise(F.lit(last))


def season_of(month: str) -> Column:
    """Winter, Spring and Summer by month; everything else is Fall."""
    chosen = None
    for season, months in list(SEASON_MONTHS.items())[:3]:
        hit = F.col(month).isin(*months)
        chosen = F.when(hit, F.lit(season)) if chosen is None else chosen.when(hit, F.lit(season))
    return chosen.otherwise(F.lit("Fall"))
