"""The six tables of the standing report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.fixed_values import CAUSE_LABELS
from skyledger.functions.numeric import asc, desc, ratio, round_to
from skyledger.operators.longform import rows_from_columns
from skyledger.operators.lookup import with_airport, with_carrier
from skyledger.operators.quantiles import WEIGHT, quantile

REPORT_CAUSES = [c for c in CAUSE_LABELS if c != "security_delay"]


def _rate(column: str) -> Column:
    """Mean of a 0/1 column, times 100."""
    return round_to(F.avg(column) * F.lit(100.0), 2)


def _delays() -> list[Column]:
    return [
        F.sum("is_delayed").alias("delayed"),
        _rate("is_delayed").alias("delay_rate_pct"),
        m.mean("arr_delay_minutes", 2).alias("avg_arr_delay_min"),
    ]


def _departures() -> list[Column]:
    return [m.mean("dep_delay_minutes", 2).alias("avg_dep_delay_min")]


def _cancellations() -> list[Column]:
    return [F.sum("cancelled").alias("cancelled"), _rate("cancelled").alias("cancel_rate_pct")]


def summary(flights: DataFrame) -> DataFrame:
    """Thirteen figures as (Metric, Value) text rows.

    Delay values, carriers and origins are counted as three grouping sets of
    one scan; the totals come from the first.
    """
    cells = flights.groupingSets(
        [["arr_delay_minutes"], ["carrier_code"], ["origin"]],
        "arr_delay_minutes",
        "carrier_code",
        "origin",
    ).agg(
        (F.grouping("arr_delay_minutes") == 0).alias("is_value"),
        F.count(F.lit(1)).alias(WEIGHT),
        F.sum("is_delayed").alias("delayed"),
        F.sum("cancelled").alias("cancelled"),
        F.sum("dep_delay_minutes").alias("dep_sum"),
        F.count("dep_delay_minutes").alias("dep_count"),
        F.min("flight_date").alias("first_date"),
        F.max("flight_date").alias("last_date"),
    )

    def total(column: str) -> Column:
        return F.sum(F.when(F.col("is_value"), F.col(column)))

    value = F.when(F.col("is_value"), F.col("arr_delay_minutes"))
    known = F.when(value.isNotNull(), F.col(WEIGHT))
    figures = {
        "total_flights": total(WEIGHT),
        "delayed_flights": total("delayed"),
        "delay_rate_pct": round_to(ratio(total("delayed"), total(WEIGHT)) * 100.0, 2),
        "cancelled_flights": total("cancelled"),
        "cancel_rate_pct": round_to(ratio(total("cancelled"), total(WEIGHT)) * 100.0, 2),
        "avg_arrival_delay_min": round_to(ratio(F.sum(value * F.col(WEIGHT)), F.sum(known)), 2),
        "avg_departure_delay_min": round_to(ratio(total("dep_sum"), total("dep_count")), 2),
        "median_arrival_delay_min": round_to(quantile(value, 0.5), 2),
        "p95_arrival_delay_min": round_to(quantile(value, 0.95), 2),
        "carriers": F.count("carrier_code"),
        "origin_airports": F.count("origin"),
        "date_start": F.min("first_date"),
        "date_end": F.max("last_date"),
    }
    one_row = cells.agg(*[agg.alias(name) for name, agg in figures.items()])
    return rows_from_columns(
        one_row,
        [{"Metric": F.lit(name), "Value": F.col(name).cast("string")} for name in figures],
    )


def hourly(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy(F.col("hour_of_day").alias("hour"))
        .agg(m.flights().alias("flights"), *_delays(), *_departures())
        .orderBy(*asc("hour"))
    )


def carrier_performance(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    by_carrier = flights.groupBy("carrier_code").agg(
        m.flights().alias("flights"),
        *_delays(),
        *_departures(),
        *_cancellations(),
        *[m.mean(c, 2).alias(f"avg_{c}") for c in REPORT_CAUSES],
    )
    return (
        with_carrier(by_carrier, carriers)
        .select(
            "carrier_code", "carrier_name", *[c for c in by_carrier.columns if c != "carrier_code"]
        )
        .orderBy(*desc("delay_rate_pct"), *asc("carrier_code"))
    )


def airport_performance(
    flights: DataFrame, airports: DataFrame, min_flights: int = 100
) -> DataFrame:
    by_airport = (
        flights.groupBy(F.col("origin").alias("airport"))
        .agg(m.flights().alias("departures"), *_delays(), *_cancellations())
        .filter(F.col("departures") >= min_flights)
    )
    return (
        with_airport(by_airport, airports, "airport_name", "city", "iso_region")
        .select(
            "airport",
            "airport_name",
            "city",
            F.col("iso_region").alias("state"),
            *[c for c in by_airport.columns if c != "airport"],
        )
        .orderBy(*desc("departures"), *asc("airport"))
    )


def monthly(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("month")
        .agg(m.flights().alias("flights"), *_delays(), *_departures(), *_cancellations())
        .orderBy("month")
    )


def delay_causes(flights: DataFrame) -> DataFrame:
    """Minutes by cause and carrier over delayed flights."""
    return (
        flights.filter(F.col("is_delayed") == 1)
        .groupBy("carrier_code")
        .agg(
            m.flights().alias("delayed_flights"),
            *[round_to(F.sum(c), 0).alias(f"total_{c}_min") for c in CAUSE_LABELS],
            *[m.mean(c, 2).alias(f"avg_{c}") for c in CAUSE_LABELS],
        )
        .orderBy(*desc("delayed_flights"), *asc("carrier_code"))
    )
