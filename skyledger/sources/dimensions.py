"""Airport, carrier and calendar dimensions. Each has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.fixed_values import CARRIER_NAMES
from skyledger.functions.labels import season_of
from skyledger.functions.numeric import asc, desc

AIRPORT_SCHEMA = (
    "iata_code string, airport_name string, latitude double, longitude double, "
    "iso_country string, iso_region string, city string, airport_type string"
)


def airports_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Airports from a quoted CSV; rows without an IATA code are dropped."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"', inferSchema=False)
    return raw.filter(F.trim("iata_code") != "").select(
        "iata_code",
        F.col("name").alias("airport_name"),
        F.col("latitude_deg").try_cast("double").alias("latitude"),
        F.col("longitude_deg").try_cast("double").alias("longitude"),
        "iso_country",
        "iso_region",
        F.col("municipality").alias("city"),
        F.col("type").alias("airport_type"),
    )


def carrier_names(spark: SparkSession) -> DataFrame:
    """The fixed carrier code and name pairs, as a local relation."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in CARRIER_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(carrier_code, carrier_name)")


def carrier_dimension(flights: DataFrame, names: DataFrame) -> DataFrame:
    """Every named carrier with its flight count, zero if it has none."""
    counts = flights.groupBy("carrier_code").agg(F.count(F.lit(1)).alias("n"))
    return (
        names.join(counts, "carrier_code", "left")
        .select(
            "carrier_code",
            "carrier_name",
            F.coalesce("n", F.lit(0).cast("long")).alias("total_flights"),
        )
        .orderBy(*desc("total_flights"), *asc("carrier_code"))
    )


def calendar_dimension(flights: DataFrame) -> DataFrame:
    """One row per distinct flight date, with its season."""
    days = flights.select(
        "flight_date", "year", "quarter", "month", "day_of_month", "day_of_week"
    ).distinct()
    return days.select(
        "*",
        F.coalesce(F.col("day_of_week").isin(6, 7), F.lit(False)).cast("int").alias("is_weekend"),
        season_of("month").alias("season"),
    ).orderBy(*asc("flight_date"))
