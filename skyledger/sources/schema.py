"""The declared schema of the flights table."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from skyledger.functions.fixed_values import CAUSE_LABELS, RAW_TO_COLUMN

INT_COLUMNS = ("year", "month", "day_of_month", "day_of_week", "cancelled")
DOUBLE_COLUMNS = (
    "crs_dep_time",
    "dep_time",
    "dep_delay",
    "dep_delay_minutes",
    "crs_arr_time",
    "arr_time",
    "arr_delay",
    "arr_delay_minutes",
    "distance",
    *CAUSE_LABELS,
)
DERIVED = {
    "arr_del15": IntegerType(),
    "dep_del15": IntegerType(),
    "hour_of_day": IntegerType(),
    "is_weekend": IntegerType(),
    "route": StringType(),
    "quarter": IntegerType(),
    "is_delayed": IntegerType(),
    "primary_delay_cause": StringType(),
}


def _source_type(name: str):
    if name == "flight_date":
        return DateType()
    if name in INT_COLUMNS:
        return IntegerType()
    return DoubleType() if name in DOUBLE_COLUMNS else StringType()


SOURCE_COLUMNS = {name: _source_type(name) for name in RAW_TO_COLUMN.values()}
FLIGHTS_SCHEMA = StructType(
    [StructField(name, kind) for name, kind in (SOURCE_COLUMNS | DERIVED).items()]
)
