"""Attach names to rows that are already aggregated by code.

Dimensions have one row per code, so joining after the aggregate gives the same
rows as joining every flight, and only one row per airport or carrier is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_airport(df: DataFrame, airports: DataFrame, *columns: str, code: str = "airport"):
    """Left join: an airport outside the dimension keeps its row with nulls."""
    names = airports.select(airports["iata_code"].alias(code), *columns)
    return df.join(names, code, "left")


def with_carrier(df: DataFrame, carriers: DataFrame, how: str = "left") -> DataFrame:
    """``left`` keeps carriers outside the dimension, ``inner`` drops them."""
    return df.join(carriers.select("carrier_code", "carrier_name"), "carrier_code", how)
