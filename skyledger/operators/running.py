"""Running totals over all rows in an order, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import write_shared


def running_sums(df: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """Add ``<column>_so_far``: the sum of all rows up to and including this one.

    Rows are sorted over ranges and written once, so that every range is summed by a task of its
    own; the totals of the ranges before it, a row a range, are then added.
    """
    ranged, _ = write_shared(
        df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranged"
    )
    totals = ranged.groupBy("__range").agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    before = Window.partitionBy().orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__range", *[F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__{c}") for c in columns]
    )
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(offsets), "__range").select(
        *df.columns, *[(F.sum(c).over(within) + F.col(f"__{c}")).alias(f"{c}_so_far") for c in columns]
    )
