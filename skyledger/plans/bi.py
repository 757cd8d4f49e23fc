"""Ratios for BI models, and the small reshapes a chart applies to a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.fixed_values import MONTH_ABBREVIATIONS
from skyledger.functions.labels import label_of
from skyledger.functions.numeric import asc, ratio
from skyledger.operators.scoring import over_all
from skyledger.operators.topk import top_k


def on_time_ratio() -> Column:
    """Known on-time arrivals over flights not cancelled; 0 if there are none."""
    completed = F.col("cancelled") == 0
    on_time = F.count_if((F.col("arr_del15") == 0) & completed)
    return F.coalesce(ratio(on_time, F.count_if(completed)), F.lit(0.0))


def delay_ratio() -> Column:
    """One minus the on-time ratio, so an unknown arrival counts as delayed."""
    return F.lit(1.0) - on_time_ratio()


def avg_delay() -> Column:
    return F.avg(F.when(F.col("cancelled") == 0, F.col("arr_delay_minutes")))


def cancel_ratio() -> Column:
    cancelled = F.count_if(F.col("cancelled") == 1)
    return F.coalesce(ratio(cancelled, F.count(F.lit(1))), F.lit(0.0))


def bi_measures(flights: DataFrame, *keys: str) -> DataFrame:
    """The four ratios over any grouping."""
    return flights.groupBy(*keys).agg(
        on_time_ratio().alias("on_time"),
        delay_ratio().alias("delay"),
        avg_delay().alias("avg_delay_min"),
        cancel_ratio().alias("cancel"),
    )


def yoy_delay_change(flights: DataFrame) -> DataFrame:
    """Average delay against the same calendar month a year earlier.

    Aligned by calendar, so a missing month leaves a gap; without a prior year,
    or with a prior mean of zero, the change is 0.
    """
    monthly = flights.groupBy("year", "month").agg(avg_delay().alias("avg_delay_min"))
    same_month = Window.partitionBy("month").orderBy("year")
    is_prior = F.lag("year").over(same_month) == F.col("year") - 1
    prior = F.when(is_prior, F.lag("avg_delay_min").over(same_month))
    change = F.col("avg_delay_min") - F.col("prior_year")
    return (
        monthly.withColumn("prior_year", prior)
        .withColumn(
            "yoy_delay_change", F.coalesce(ratio(change, F.col("prior_year")), F.lit(0.0))
        )
        .orderBy("year", "month")
    )


def carriers_by_delay(carriers: DataFrame, limit: int = 15) -> DataFrame:
    """Carrier results ordered by average delay, shortest first."""
    return top_k(carriers, asc("avg_delay", "carrier_code"), limit)


def normalised_heatmap(cells: DataFrame) -> DataFrame:
    """Delay rates scaled to 0..1 between the smallest and largest cell; 0 if all are equal."""
    low = F.min("delay_rate").over(over_all())
    high = F.max("delay_rate").over(over_all())
    scaled = F.when(high == low, F.lit(0.0)).otherwise(
        ratio(F.col("delay_rate") - low, high - low)
    )
    return cells.withColumn("intensity", scaled)


def month_labels(trends: DataFrame) -> DataFrame:
    """Monthly results with a ``Mon YYYY`` label."""
    name = label_of("month", MONTH_ABBREVIATIONS)
    return trends.withColumn("label", F.concat_ws(" ", name, F.col("year").cast("string")))
