"""Ranks and weighted percentile scores over an aggregated table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.numeric import asc, round_to

# Windows without a partition run in one task. They are used on aggregates only,
# where rows are airports, carriers, routes, days or months and never flights.


def over_all(*order: Column) -> Window:
    return Window.partitionBy().orderBy(*order) if order else Window.partitionBy()


def rank_by(*order: Column) -> Column:
    return F.rank().over(over_all(*order)).cast("long")


def dense_rank_by(*order: Column) -> Column:
    return F.dense_rank().over(over_all(*order)).cast("long")


def position_by(*order: Column) -> Column:
    return F.row_number().over(over_all(*order)).cast("long")


def tile_by(n: int, *order: Column) -> Column:
    return F.ntile(n).over(over_all(*order)).cast("long")


def percentile_rank(column: str) -> Column:
    """Share of rows below this one, from 0 to 1; nulls rank highest."""
    return F.percent_rank().over(over_all(*asc(column)))


def composite_score(df: DataFrame, weights: dict[str, float], name: str, digits: int) -> DataFrame:
    """Add the weighted sum of each column's percentile rank, rounded."""
    parts = [F.lit(weight) * percentile_rank(column) for column, weight in weights.items()]
    return df.withColumn(name, round_to(reduce(Column.__add__, parts), digits))


def share_of_total(column: str, digits: int) -> Column:
    """This row's percentage of the column's total over all rows."""
    total = F.sum(column).over(over_all()).cast("double")
    value = F.try_divide(F.lit(100.0) * F.col(column).cast("double"), total)
    return round_to(value, digits)
