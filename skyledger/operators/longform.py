"""One aggregate row turned into one row per label, so the table is scanned once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_from_columns(one_row: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """One output row per dict, each mapping output name to an expression over the input."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))
