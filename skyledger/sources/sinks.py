"""Files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.sources.schema import FLIGHTS_SCHEMA

PARTITION_COLUMNS = ("year", "month")


def dealt(flights: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Rows shuffled by the folders they go to and put in date order.

    The rebalance hint lets adaptive execution split a large folder over many
    tasks and pack small ones together, so files come out even whatever the
    skew.  Date order lets a reader skip row groups outside its dates.
    """
    together = flights.hint("rebalance", *partition_by)
    return together.sortWithinPartitions(*partition_by, "flight_date")


def write_flights(
    flights: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: tuple[str, ...] = PARTITION_COLUMNS,
    deal: bool = True,
) -> None:
    """Write flights as Parquet folders. Pass ``deal=False`` for rows already dealt."""
    rows = dealt(flights, partition_by) if deal else flights
    rows.write.partitionBy(*partition_by).mode(mode).parquet(path)


def replace_months(flights: DataFrame, path: str) -> None:
    """Write the months that ``flights`` has in place of the same months at ``path``.

    Other folders are neither read nor written. Files are staged beside the table and take the
    place of the old ones when all tasks are done, so a failed load leaves the table as it was.
    ``flights`` must not be read from ``path`` itself.
    """
    rows = dealt(flights, PARTITION_COLUMNS).write.partitionBy(*PARTITION_COLUMNS)
    rows.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_flights(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """Read written flights by their declared schema, optionally registering a view."""
    flights = spark.read.schema(FLIGHTS_SCHEMA).parquet(path).select(*FLIGHTS_SCHEMA.names)
    if view:
        flights.createOrReplaceTempView(view)
    return flights


def write_table(
    df: DataFrame, path: str, file_format: str = "csv", mode: str = "errorifexists"
) -> None:
    """Write any table as ``csv`` (with header), ``json`` (lines) or ``parquet``."""
    writer = df.write.mode(mode)
    if file_format == "csv":
        writer.option("header", True).csv(path)
    elif file_format == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif file_format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"Unknown format {file_format!r}. Available: csv, json, parquet")
