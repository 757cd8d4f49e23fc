"""The dashboard results: small, ordered tables over flights; ``max_rows`` caps one if given.

Rates here come from ``is_delayed``, which is never null, and the average delay
covers flights that were late by any amount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.fixed_values import CANCELLATION_REASONS, CAUSE_LABELS, DAY_NAMES
from skyledger.functions.labels import label_of
from skyledger.functions.numeric import asc, desc, pct
from skyledger.operators.longform import rows_from_columns
from skyledger.operators.lookup import with_airport, with_carrier
from skyledger.operators.scoring import position_by, share_of_total
from skyledger.operators.topk import top_k


def _completed(flights: DataFrame) -> DataFrame:
    return flights.filter(F.col("cancelled") == 0)


def overview(flights: DataFrame) -> DataFrame:
    return flights.agg(
        m.flights().alias("total_flights"),
        m.on_time_api().alias("on_time_pct"),
        m.delay_rate_flag().alias("delay_pct"),
        m.cancel_rate_by_count().alias("cancel_pct"),
        m.avg_delay_positive().alias("avg_delay_min"),
    )


def delays_by_hour(flights: DataFrame, max_rows: int | None = None) -> DataFrame:
    by_hour = (
        _completed(flights)
        .groupBy(F.col("hour_of_day").alias("hour"))
        .agg(
            m.delay_rate_flag().alias("delay_rate"),
            m.avg_delay_positive().alias("avg_delay"),
            m.flights().alias("flight_count"),
        )
    )
    return top_k(by_hour, asc("hour"), max_rows)


def _carriers(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    """Known carriers only, placed by the unrounded on-time share."""
    by_carrier = flights.groupBy("carrier_code").agg(
        m.flights().alias("total_flights"),
        m.on_time_api(None).alias("exact_on_time"),
        m.on_time_api().alias("on_time_pct"),
        m.delay_rate_flag().alias("delay_pct"),
        m.cancel_rate_by_count().alias("cancel_pct"),
        m.avg_delay_positive().alias("avg_delay"),
    )
    return with_carrier(by_carrier, carriers, "inner").withColumn(
        "rank", position_by(*desc("exact_on_time"), *asc("carrier_code"))
    )


def delays_by_carrier(
    flights: DataFrame, carriers: DataFrame, max_rows: int | None = None
) -> DataFrame:
    ranked = _carriers(flights, carriers).select(
        "carrier_code", "carrier_name", "total_flights", "on_time_pct", "avg_delay", "rank"
    )
    return top_k(ranked, asc("rank"), max_rows)


def carrier_ranking(
    flights: DataFrame, carriers: DataFrame, max_rows: int | None = None
) -> DataFrame:
    ranked = _carriers(flights, carriers).select(
        "carrier_code",
        "carrier_name",
        "total_flights",
        "on_time_pct",
        "delay_pct",
        "cancel_pct",
        "avg_delay",
        "rank",
    )
    return top_k(ranked, asc("rank"), max_rows)


def airport_delays(flights: DataFrame, airports: DataFrame, min_flights: int = 1000) -> DataFrame:
    """Origins with enough completed flights; the code stands in for a missing name."""
    by_origin = (
        _completed(flights)
        .groupBy(F.col("origin").alias("airport_code"))
        .agg(
            m.flights().alias("total_flights"),
            m.delay_rate_flag().alias("delay_rate"),
            m.avg_delay_positive().alias("avg_delay"),
        )
        .filter(F.col("total_flights") >= min_flights)
    )
    return with_airport(by_origin, airports, "airport_name", code="airport_code").select(
        "airport_code",
        F.coalesce("airport_name", "airport_code").alias("airport_name"),
        "total_flights",
        "delay_rate",
        "avg_delay",
    )


def delays_by_airport(
    flights: DataFrame, airports: DataFrame, limit: int = 20, min_flights: int = 1000
) -> DataFrame:
    _check_limit(limit)
    rows = airport_delays(flights, airports, min_flights)
    return top_k(rows, [*desc("delay_rate"), *asc("airport_code")], limit)


def cause_minutes(flights: DataFrame) -> DataFrame:
    """Minutes of each cause over delayed flights, zero where none is recorded."""
    totals = flights.filter(F.col("is_delayed") == 1).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in CAUSE_LABELS]
    )
    return rows_from_columns(
        totals,
        [
            {"cause": F.lit(label), "total_minutes": F.col(c)}
            for c, label in CAUSE_LABELS.items()
        ],
    )


def delay_causes(flights: DataFrame, max_rows: int | None = None) -> DataFrame:
    shares = cause_minutes(flights).withColumn("percentage", share_of_total("total_minutes", 2))
    return top_k(shares, [*desc("total_minutes"), *asc("cause")], max_rows)


def monthly_trends(flights: DataFrame, max_rows: int | None = None) -> DataFrame:
    monthly = (
        _completed(flights)
        .groupBy("year", "month")
        .agg(
            m.delay_rate_flag().alias("delay_rate"),
            m.avg_delay_positive().alias("avg_delay"),
            m.flights().alias("total_flights"),
        )
    )
    return top_k(monthly, asc("year", "month"), max_rows)


def day_of_week_patterns(flights: DataFrame, max_rows: int | None = None) -> DataFrame:
    by_day = (
        _completed(flights)
        .groupBy("day_of_week")
        .agg(
            m.delay_rate_flag().alias("delay_rate"),
            m.avg_delay_positive().alias("avg_delay"),
            m.flights().alias("total_flights"),
        )
    )
    named = by_day.select(
        "day_of_week",
        label_of("day_of_week", DAY_NAMES, "Unknown").alias("day_name"),
        "delay_rate",
        "avg_delay",
        "total_flights",
    )
    return top_k(named, asc("day_of_week"), max_rows)


def delay_heatmap(flights: DataFrame, max_rows: int | None = None) -> DataFrame:
    cells = (
        _completed(flights)
        .groupBy(F.col("hour_of_day").alias("hour"), "day_of_week")
        .agg(m.delay_rate_flag().alias("delay_rate"), m.flights().alias("flight_count"))
    )
    return top_k(cells, asc("hour", "day_of_week"), max_rows)


def top_routes(
    flights: DataFrame, sort: str = "worst", limit: int = 20, min_flights: int = 500
) -> DataFrame:
    if sort not in ("best", "worst"):
        raise ValueError(f"sort must be 'best' or 'worst', not {sort!r}")
    _check_limit(limit)
    routes = (
        _completed(flights)
        .groupBy("route", "origin", "dest")
        .agg(
            m.flights().alias("total_flights"),
            m.delay_rate_flag().alias("delay_rate"),
            m.avg_delay_positive().alias("avg_delay"),
        )
        .filter(F.col("total_flights") >= min_flights)
    )
    by_rate = desc("delay_rate") if sort == "worst" else asc("delay_rate")
    return top_k(routes, [*by_rate, *asc("route")], limit)


def cancellation_counts(flights: DataFrame) -> DataFrame:
    by_code = (
        flights.filter(F.col("cancelled") == 1)
        .groupBy("cancellation_code")
        .agg(m.flights().alias("count"))
    )
    return by_code.select(
        "cancellation_code",
        label_of("cancellation_code", CANCELLATION_REASONS, "Unknown").alias("reason"),
        "count",
    )


def cancellations(flights: DataFrame, max_rows: int | None = None) -> DataFrame:
    shares = cancellation_counts(flights).withColumn("percentage", share_of_total("count", 2))
    return top_k(shares, [*desc("count"), *asc("cancellation_code")], max_rows)


def _check_limit(limit: int) -> None:
    if limit < 1:
        raise ValueError("limit must be at least 1")


# Carrier lists without a rank column, shared by exports and questions.


def carrier_rates(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    by_carrier = flights.groupBy("carrier_code").agg(
        m.flights().alias("total_flights"),
        m.on_time_api().alias("on_time_pct"),
        m.delay_rate_flag().alias("delay_pct"),
        pct(F.sum("cancelled"), m.flights()).alias("cancel_pct"),
        m.avg_delay_positive().alias("avg_delay"),
    )
    return with_carrier(by_carrier, carriers, "inner").select(
        "carrier_code",
        "carrier_name",
        "total_flights",
        "on_time_pct",
        "delay_pct",
        "cancel_pct",
        "avg_delay",
    )
