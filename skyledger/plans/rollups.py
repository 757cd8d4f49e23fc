"""The three standing rollups: airport by day, carrier by month, and route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.numeric import pct, ratio, round_to
from skyledger.operators.lookup import with_carrier
from skyledger.operators.quantiles import WEIGHT, count_values, quantile, weighted_mean


CARRIER_MONTH = ["year", "month", "carrier_code"]


def daily_airport_summary(flights: DataFrame) -> DataFrame:
    return flights.groupBy(
        "flight_date", F.col("origin").alias("airport"), "year", "month", "day_of_week"
    ).agg(
        m.flights().alias("total_flights"),
        m.cancelled_count().alias("cancellations"),
        m.delayed_count().alias("delayed_flights"),
        m.delay_rate_arr15().alias("delay_rate"),
        m.mean("arr_delay_minutes", 1).alias("avg_arr_delay_minutes"),
        m.mean("dep_delay_minutes", 1).alias("avg_dep_delay_minutes"),
        F.sum("carrier_delay").alias("total_carrier_delay"),
        F.sum("weather_delay").alias("total_weather_delay"),
        F.sum("nas_delay").alias("total_nas_delay"),
        F.sum("late_aircraft_delay").alias("total_late_aircraft_delay"),
    )


def carrier_delay_counts(flights: DataFrame) -> DataFrame:
    """Flights of each carrier and month by arrival delay, with sums."""
    return count_values(
        flights,
        CARRIER_MONTH,
        "arr_delay",
        cancelled=m.cancelled_count(),
        delayed=m.delayed_count(),
        minutes=F.sum("arr_delay_minutes"),
    )


def monthly_carrier_performance(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    return carrier_performance(carrier_delay_counts(flights), carriers)


def carrier_performance(counted: DataFrame, carriers: DataFrame) -> DataFrame:
    """The rollup of carriers and months from ``carrier_delay_counts``."""
    keys = CARRIER_MONTH
    total = F.sum(WEIGHT)
    late = ratio(F.sum("delayed"), total)
    by_carrier = counted.groupBy(*keys).agg(
        total.alias("total_flights"),
        F.sum("cancelled").alias("cancellations"),
        pct(F.sum("cancelled"), total).alias("cancellation_rate"),
        F.sum("delayed").alias("delayed_flights"),
        round_to(F.lit(100.0) * (F.lit(1.0) - late), 2).alias("on_time_pct"),
        round_to(weighted_mean("arr_delay"), 1).alias("avg_arr_delay"),
        round_to(quantile("arr_delay", 0.5), 1).alias("median_arr_delay"),
        round_to(quantile("arr_delay", 0.95), 1).alias("p95_arr_delay"),
        F.sum("minutes").alias("total_delay_minutes"),
    )
    return with_carrier(by_carrier, carriers).select(
        *keys, "carrier_name", *[c for c in by_carrier.columns if c not in keys]
    )


def route_reliability(flights: DataFrame, min_flights: int = 100) -> DataFrame:
    return (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("origin", "dest", "route")
        .agg(
            m.flights().alias("total_flights"),
            m.delay_rate_arr15().alias("delay_rate"),
            m.on_time_complement().alias("on_time_pct"),
            m.mean("arr_delay_minutes", 1).alias("avg_delay_minutes"),
            m.mean("distance", 0).alias("avg_distance"),
            F.countDistinct("carrier_code").alias("num_carriers"),
        )
        .filter(F.col("total_flights") >= min_flights)
    )


def install_views(flights: DataFrame, carriers: DataFrame, prefix: str = "v_") -> list[str]:
    """Register the rollups as temporary views and return their names."""
    views = {
        f"{prefix}daily_airport_summary": daily_airport_summary(flights),
        f"{prefix}monthly_carrier_performance": monthly_carrier_performance(flights, carriers),
        f"{prefix}route_reliability": route_reliability(flights),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)


def install_tables(spark: SparkSession, **tables: DataFrame) -> list[str]:
    """Register DataFrames as temporary views and list every table the session knows."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return sorted(t.name for t in spark.catalog.listTables())
