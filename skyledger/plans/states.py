"""The standing rollups kept as sums and counts by month, merged on reading.

A new load writes the states of its own months only; nothing else is computed again. States of
one key merge by adding up, so a month may also come in parts. Medians and distinct counts merge
too, because states hold value counts and one row a carrier.

Loading replaces the months that it has, or adds to them with ``add``. Rows without a date lie in a
folder of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.numeric import ratio, round_to
from skyledger.plans.rollups import carrier_delay_counts, carrier_performance

MONTH = ("year", "month")
CAUSES = ("carrier_delay", "weather_delay", "nas_delay", "late_aircraft_delay")
# State tables: the columns that name a state; all others add up.
KEYS = {
    "airport_days": ("flight_date", "airport", "day_of_week", *MONTH),
    "carrier_delays": ("carrier_code", "arr_delay", *MONTH),
    "route_carriers": ("origin", "dest", "route", "carrier_code", *MONTH),
}


def airport_days(flights: DataFrame) -> DataFrame:
    return flights.withColumn("airport", F.col("origin")).groupBy(*KEYS["airport_days"]).agg(
        m.flights().alias("n"),
        m.cancelled_count().alias("cancelled"),
        m.delayed_count().alias("late"),
        *_known("arr_delay_minutes"),
        *_known("dep_delay_minutes"),
        *[F.sum(c).alias(c) for c in CAUSES],
    )


def route_carriers(flights: DataFrame) -> DataFrame:
    return flights.filter(F.col("cancelled") == 0).groupBy(*KEYS["route_carriers"]).agg(
        m.flights().alias("n"),
        m.delayed_count().alias("late"),
        *_known("arr_delay_minutes"),
        *_known("distance"),
    )


def _known(column: str) -> list:
    return [F.sum(column).alias(column), F.count(column).alias(f"{column}_n")]


STATES = {
    "airport_days": airport_days,
    "carrier_delays": carrier_delay_counts,
    "route_carriers": route_carriers,
}


def load(flights: DataFrame, path: str, add: bool = False) -> None:
    """Write the states of ``flights`` in place of those of the same months, or beside them."""
    for name, make in STATES.items():
        rows = make(flights).hint("rebalance", *MONTH).write.partitionBy(*MONTH)
        if add:
            rows.mode("append").parquet(f"{path}/{name}")
        else:
            dynamic = rows.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            dynamic.parquet(f"{path}/{name}")


def merged(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One row for each key of a state table."""
    states = spark.read.parquet(f"{path}/{name}")
    sums = [F.sum(c).alias(c) for c in states.columns if c not in KEYS[name]]
    return states.groupBy(*KEYS[name]).agg(*sums)


def _mean(column: str, digits: int):
    return round_to(ratio(F.col(column), F.col(f"{column}_n")), digits)


def _late_pct():
    return F.lit(100.0) * ratio(F.col("late"), F.col("n"))


def daily_airport_summary(spark: SparkSession, path: str) -> DataFrame:
    return merged(spark, path, "airport_days").select(
        "flight_date", "airport", "year", "month", "day_of_week",
        F.col("n").alias("total_flights"),
        F.col("cancelled").alias("cancellations"),
        F.col("late").alias("delayed_flights"),
        round_to(_late_pct(), 2).alias("delay_rate"),
        _mean("arr_delay_minutes", 1).alias("avg_arr_delay_minutes"),
        _mean("dep_delay_minutes", 1).alias("avg_dep_delay_minutes"),
        *[F.col(c).alias(f"total_{c}") for c in CAUSES],
    )


def monthly_carrier_performance(spark: SparkSession, path: str, carriers: DataFrame) -> DataFrame:
    return carrier_performance(merged(spark, path, "carrier_delays"), carriers)


def route_reliability(spark: SparkSession, path: str, min_flights: int = 100) -> DataFrame:
    """A carrier counts once for a route, however many months it flew there."""
    route = ["origin", "dest", "route"]
    by_carrier = merged(spark, path, "route_carriers").drop(*MONTH)
    sums = [F.sum(c).alias(c) for c in by_carrier.columns if c not in KEYS["route_carriers"]]
    routes = (
        by_carrier.groupBy(*route, "carrier_code").agg(*sums).groupBy(*route).agg(
            *[F.sum(c).alias(c) for c in by_carrier.columns if c not in KEYS["route_carriers"]],
            F.count("carrier_code").alias("num_carriers"),
        )
    )
    return routes.filter(F.col("n") >= min_flights).select(
        *route,
        F.col("n").alias("total_flights"),
        round_to(_late_pct(), 2).alias("delay_rate"),
        round_to(F.lit(100.0) * (F.lit(1.0) - ratio(F.col("late"), F.col("n"))), 2).alias("on_time_pct"),
        _mean("arr_delay_minutes", 1).alias("avg_delay_minutes"),
        _mean("distance", 0).alias("avg_distance"),
        "num_carriers",
    )
