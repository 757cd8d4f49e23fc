"""Data-quality checks on a loaded flights table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.fixed_values import CANCELLATION_REASONS_QUALITY
from skyledger.functions.labels import label_of
from skyledger.functions.numeric import asc, desc, pct, round_to
from skyledger.operators.longform import rows_from_columns
from skyledger.operators.lookup import with_carrier
from skyledger.operators.quantiles import WEIGHT, count_values, quantile, weighted_mean
from skyledger.operators.scoring import share_of_total
from skyledger.operators.topk import top_k

# Columns profiled for nulls, and columns of the load profile.
KEY_COLUMNS = (
    "arr_delay",
    "dep_delay",
    "arr_delay_minutes",
    "dep_delay_minutes",
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "cancelled",
    "cancellation_code",
    "distance",
)
LOAD_COLUMNS = (
    "arr_delay",
    "dep_delay",
    "arr_delay_minutes",
    "dep_delay_minutes",
    "carrier_delay",
    "weather_delay",
    "cancelled",
    "origin",
    "dest",
)


def volume_by_month(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("year", "month")
        .agg(
            m.flights().alias("flight_count"),
            F.countDistinct("origin").alias("unique_origins"),
            F.countDistinct("dest").alias("unique_dests"),
            F.countDistinct("carrier_code").alias("unique_carriers"),
            F.min("flight_date").alias("first_date"),
            F.max("flight_date").alias("last_date"),
        )
        .orderBy("year", "month")
    )


def null_profile(
    df: DataFrame,
    columns: tuple[str, ...] | list[str] = KEY_COLUMNS,
    digits: int | None = 1,
    only_missing: bool = False,
) -> DataFrame:
    """Null percentage of each column, all counted in one pass."""
    counts = df.agg(
        m.flights().alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    long = rows_from_columns(
        counts,
        [
            {"column_name": F.lit(c), "null_pct": pct(F.col(c), F.col("rows"), digits)}
            for c in columns
        ],
    )
    if only_missing:
        long = long.filter(F.col("null_pct") > 0)
    return long.orderBy(*desc("null_pct"), *asc("column_name"))


def column_names(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields]


def delay_distribution(flights: DataFrame) -> DataFrame:
    counted = count_values(flights.filter(F.col("arr_delay").isNotNull()), [], "arr_delay")
    delay = F.col("arr_delay")

    def flights_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col(WEIGHT))), F.lit(0).cast("long"))

    return counted.agg(
        F.min(delay).alias("min_delay"),
        quantile("arr_delay", 0.01).alias("p01"),
        quantile("arr_delay", 0.25).alias("p25"),
        quantile("arr_delay", 0.5).alias("median"),
        round_to(weighted_mean("arr_delay"), 1).alias("mean"),
        quantile("arr_delay", 0.75).alias("p75"),
        quantile("arr_delay", 0.95).alias("p95"),
        quantile("arr_delay", 0.99).alias("p99"),
        F.max(delay).alias("max_delay"),
        flights_where(delay < 0).alias("early_arrivals"),
        flights_where((delay >= 0) & (delay < 15)).alias("on_time"),
        flights_where(delay >= 15).alias("delayed"),
    )


def cancellation_codes(flights: DataFrame) -> DataFrame:
    by_code = (
        flights.filter(F.col("cancelled") == 1)
        .groupBy("cancellation_code")
        .agg(m.flights().alias("count"))
    )
    return by_code.select(
        "cancellation_code",
        label_of("cancellation_code", CANCELLATION_REASONS_QUALITY, "Unknown").alias("reason"),
        "count",
        share_of_total("count", 2).alias("pct"),
    ).orderBy(*desc("count"), *asc("cancellation_code"))


def orphan_airports(flights: DataFrame, airports: DataFrame, limit: int = 20) -> DataFrame:
    """Origins without an airport row; counted first, so the anti join sees one row each."""
    by_origin = flights.groupBy(F.col("origin").alias("orphan_airport")).agg(
        m.flights().alias("flight_count")
    )
    known = airports.select(F.col("iata_code").alias("orphan_airport"))
    orphans = by_origin.join(known, "orphan_airport", "left_anti")
    return top_k(orphans, [*desc("flight_count"), *asc("orphan_airport")], limit)


def daily_volume_distribution(flights: DataFrame) -> DataFrame:
    daily = flights.groupBy("flight_date").agg(m.flights().alias("daily_flights"))
    n = F.col("daily_flights")

    def at(q: float):
        return F.percentile(n, F.lit(q))

    return daily.agg(
        F.min(n).alias("min_daily"),
        at(0.25).alias("p25_daily"),
        round_to(F.avg(n), 0).alias("avg_daily"),
        at(0.5).alias("median_daily"),
        at(0.75).alias("p75_daily"),
        F.max(n).alias("max_daily"),
        F.count(F.lit(1)).alias("total_days"),
    )


def load_profile(flights: DataFrame) -> DataFrame:
    """Count, date range, arrival delay rate and null percentages after a load, in one pass."""
    completed = F.col("cancelled") == 0
    late = F.when(completed, F.when(F.col("arr_del15") == 1, 1.0).otherwise(0.0))
    return flights.agg(
        m.flights().alias("total_flights"),
        F.min("flight_date").alias("first_date"),
        F.max("flight_date").alias("last_date"),
        round_to(F.lit(100.0) * F.avg(late), 1).alias("delay_rate_pct"),
        *[
            pct(F.count_if(F.col(c).isNull()), m.flights(), 1).alias(f"{c}_null_pct")
            for c in LOAD_COLUMNS
        ],
    )


def load_flights_by_month(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("year", "month").agg(m.flights().alias("flights")).orderBy("year", "month")
    )


def load_top_origins(flights: DataFrame, limit: int = 10) -> DataFrame:
    by_origin = flights.groupBy("origin").agg(m.flights().alias("flights"))
    return top_k(by_origin, [*desc("flights"), *asc("origin")], limit)


def load_top_carriers(flights: DataFrame, carriers: DataFrame, limit: int = 10) -> DataFrame:
    by_carrier = (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("carrier_code")
        .agg(m.flights().alias("flights"), m.delay_rate_arr15(1).alias("delay_pct"))
    )
    named = with_carrier(by_carrier, carriers)
    return top_k(named, [*desc("flights"), *asc("carrier_code")], limit).select(
        "carrier_code", "carrier_name", "flights", "delay_pct"
    )
