"""Exact quantiles from value counts.

A quantile needs every value of a group.  Counting each (group, value) pair
first lets Spark combine on the map side and spreads a hot group over as many
tasks as it has values; the second step then sees one row per distinct value.
Delays are whole minutes, so that is a few thousand rows per group however many
flights there are.  Other measures ride along as sums in the first step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHT = "value_count"


def count_values(df: DataFrame, keys: list[str], value: str, **partials: Column) -> DataFrame:
    """One row per (keys, value) with its count and any partial aggregates."""
    return df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias(WEIGHT), *[agg.alias(name) for name, agg in partials.items()]
    )


def quantile(value: str | Column, at: float, weight: str | Column = WEIGHT) -> Column:
    """Linearly interpolated quantile over counted values; null values are ignored."""
    value = F.col(value) if isinstance(value, str) else value
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.percentile(value, F.lit(at), weight)


def weighted_mean(value: str, weight: str = WEIGHT) -> Column:
    """Mean of the original rows; null values are ignored."""
    known = F.when(F.col(value).isNotNull(), F.col(weight))
    total = F.sum(F.col(value) * F.col(weight))
    return F.try_divide(total, F.sum(known).cast("double"))


def whiskers(q1: str, q3: str, low: str, high: str, reach: float = 1.5) -> tuple[Column, Column]:
    """Box-plot whisker ends: the quartiles extended by ``reach`` box heights, kept in range."""
    height = F.col(q3) - F.col(q1)
    return (
        F.greatest(F.col(low), F.col(q1) - F.lit(reach) * height),
        F.least(F.col(high), F.col(q3) + F.lit(reach) * height),
    )
