"""Exploratory questions about flights: totals, time of day, airports, carriers, routes, causes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.fixed_values import CAUSE_LABELS, DAY_NAMES, MONTH_ABBREVIATIONS
from skyledger.functions.labels import label_of
from skyledger.functions.numeric import asc, desc, round_to
from skyledger.operators.longform import rows_from_columns
from skyledger.operators.lookup import with_airport, with_carrier
from skyledger.operators.scoring import share_of_total
from skyledger.operators.topk import top_k


def kpi_summary(flights: DataFrame) -> DataFrame:
    """One row of totals. Delay rate is over completed flights, cancel rate over all."""
    completed = F.col("cancelled") == 0

    def completed_mean(column: str, digits: int):
        return round_to(F.avg(F.when(completed, F.col(column))), digits)

    return flights.agg(
        m.flights().alias("total_flights"),
        F.count_if(completed).alias("completed_flights"),
        m.cancelled_count().alias("cancelled_flights"),
        m.cancel_rate_by_count().alias("cancel_rate_pct"),
        m.delayed_count().alias("delayed_flights"),
        m.delay_rate_completed().alias("delay_rate_pct"),
        completed_mean("arr_delay", 1).alias("avg_arr_delay_min"),
        completed_mean("dep_delay", 1).alias("avg_dep_delay_min"),
        completed_mean("arr_delay_minutes", 1).alias("avg_arr_delay_positive_min"),
        completed_mean("distance", 0).alias("avg_distance_miles"),
    )


def delay_by_hour(flights: DataFrame) -> DataFrame:
    return (
        flights.filter((F.col("cancelled") == 0) & F.col("hour_of_day").isNotNull())
        .groupBy("hour_of_day")
        .agg(
            m.flights().alias("flights"),
            m.delay_rate_arr15().alias("delay_rate_pct"),
            m.mean("arr_delay", 1).alias("avg_arr_delay"),
            m.mean("dep_delay", 1).alias("avg_dep_delay"),
        )
        .orderBy("hour_of_day")
    )


def delay_by_day_of_week(flights: DataFrame) -> DataFrame:
    by_day = (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("day_of_week")
        .agg(
            m.flights().alias("flights"),
            m.delay_rate_arr15().alias("delay_rate_pct"),
            m.mean("arr_delay", 1).alias("avg_arr_delay"),
        )
    )
    return by_day.select(
        "day_of_week",
        label_of("day_of_week", DAY_NAMES).alias("day_name"),
        "flights",
        "delay_rate_pct",
        "avg_arr_delay",
    ).orderBy("day_of_week")


def delay_by_month(flights: DataFrame) -> DataFrame:
    """By calendar month over all years, cancelled flights included."""
    by_month = flights.groupBy("month").agg(
        m.flights().alias("flights"),
        m.delay_rate_arr15().alias("delay_rate_pct"),
        m.cancel_rate().alias("cancel_rate_pct"),
        m.avg_delay_minutes().alias("avg_delay_min"),
    )
    return by_month.select(
        "month",
        label_of("month", MONTH_ABBREVIATIONS).alias("month_name"),
        "flights",
        "delay_rate_pct",
        "cancel_rate_pct",
        "avg_delay_min",
    ).orderBy("month")


def busiest_airports(flights: DataFrame, airports: DataFrame, limit: int = 10) -> DataFrame:
    """Largest origins by departures. Names join after the aggregate, airport by airport."""
    by_origin = flights.groupBy(F.col("origin").alias("airport")).agg(
        m.flights().alias("departures"),
        m.delay_rate_arr15().alias("delay_rate_pct"),
        m.avg_delay_minutes().alias("avg_delay_min"),
    )
    named = with_airport(by_origin, airports, "airport_name", "city")
    return top_k(named, [*desc("departures"), *asc("airport")], limit).select(
        "airport", "airport_name", "city", "departures", "delay_rate_pct", "avg_delay_min"
    )


def most_delayed_airports(
    flights: DataFrame, airports: DataFrame, min_flights: int = 5000, limit: int = 10
) -> DataFrame:
    by_origin = (
        flights.filter(F.col("cancelled") == 0)
        .groupBy(F.col("origin").alias("airport"))
        .agg(
            m.flights().alias("departures"),
            m.delay_rate_arr15().alias("delay_rate_pct"),
            m.mean("arr_delay", 1).alias("avg_arr_delay"),
            m.mean("dep_delay", 1).alias("avg_dep_delay"),
        )
        .filter(F.col("departures") >= min_flights)
    )
    named = with_airport(by_origin, airports, "airport_name")
    return top_k(named, [*desc("delay_rate_pct"), *asc("airport")], limit).select(
        "airport", "airport_name", "departures", "delay_rate_pct", "avg_arr_delay", "avg_dep_delay"
    )


def carrier_on_time(flights: DataFrame, carriers: DataFrame, min_flights: int = 1000) -> DataFrame:
    """Carriers by on-time share. ``avg_delay_when_late`` keeps zeros, despite its name."""
    by_carrier = (
        flights.groupBy("carrier_code")
        .agg(
            m.flights().alias("total_flights"),
            m.on_time_complement().alias("on_time_pct"),
            m.mean("arr_delay", 1).alias("avg_arr_delay"),
            m.cancel_rate().alias("cancel_rate_pct"),
            m.avg_delay_minutes().alias("avg_delay_when_late"),
        )
        .filter(F.col("total_flights") >= min_flights)
    )
    return (
        with_carrier(by_carrier, carriers)
        .select(
            "carrier_code",
            "carrier_name",
            "total_flights",
            "on_time_pct",
            "avg_arr_delay",
            "cancel_rate_pct",
            "avg_delay_when_late",
        )
        .orderBy(*desc("on_time_pct"), *asc("carrier_code"))
    )


def delay_causes(flights: DataFrame) -> DataFrame:
    """Minutes, share and flights of each cause over late arrivals, in one pass."""
    totals = flights.filter(F.col("arr_del15") == 1).agg(
        *[F.sum(c).alias(c) for c in CAUSE_LABELS],
        *[F.count_if(F.col(c) > 0).alias(f"{c}_flights") for c in CAUSE_LABELS],
    )
    long = rows_from_columns(
        totals,
        [
            {
                "cause": F.lit(label),
                "total_minutes": F.col(c),
                "flight_count": F.col(f"{c}_flights"),
            }
            for c, label in CAUSE_LABELS.items()
        ],
    )
    return long.select(
        "cause",
        "total_minutes",
        share_of_total("total_minutes", 1).alias("pct_of_total"),
        "flight_count",
    ).orderBy(*desc("total_minutes"), *asc("cause"))


def _by_route(flights: DataFrame, *extra) -> DataFrame:
    return (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("route", "origin", "dest")
        .agg(
            m.flights().alias("flights"),
            m.delay_rate_arr15().alias("delay_rate_pct"),
            m.avg_delay_minutes().alias("avg_delay_min"),
            *extra,
        )
    )


def busiest_routes(flights: DataFrame, limit: int = 20) -> DataFrame:
    routes = _by_route(
        flights,
        F.countDistinct("carrier_code").alias("num_carriers"),
        m.mean("distance", 0).alias("avg_distance"),
    )
    return top_k(routes, [*desc("flights"), *asc("route")], limit).select(
        "route",
        "origin",
        "dest",
        "flights",
        "num_carriers",
        "delay_rate_pct",
        "avg_delay_min",
        "avg_distance",
    )


def weekend_vs_weekday(flights: DataFrame) -> DataFrame:
    by_weekend = flights.groupBy("is_weekend").agg(
        m.flights().alias("flights"),
        m.delay_rate_arr15().alias("delay_rate_pct"),
        m.mean("arr_delay", 1).alias("avg_arr_delay"),
        m.mean("dep_delay", 1).alias("avg_dep_delay"),
        m.cancel_rate().alias("cancel_rate_pct"),
    )
    period = F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday")
    return by_weekend.orderBy("is_weekend").select(
        period.alias("period"),
        "flights",
        "delay_rate_pct",
        "avg_arr_delay",
        "avg_dep_delay",
        "cancel_rate_pct",
    )


def worst_routes(flights: DataFrame, min_flights: int = 500, limit: int = 20) -> DataFrame:
    routes = _by_route(flights).filter(F.col("flights") >= min_flights)
    return top_k(routes, [*desc("delay_rate_pct"), *asc("route")], limit)


def primary_cause_distribution(flights: DataFrame) -> DataFrame:
    by_cause = (
        flights.filter(F.col("primary_delay_cause").isNotNull())
        .groupBy("primary_delay_cause")
        .agg(m.flights().alias("flights"))
    )
    return by_cause.withColumn("pct", share_of_total("flights", 2)).orderBy(
        *desc("flights"), *asc("primary_delay_cause")
    )
