"""Ordered top-k. Sort keys must end in a unique key so that ties have one answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, keys: list[Column], k: int | None = None) -> DataFrame:
    """The first ``k`` rows in order, each task keeping only its own best ``k``; all if None."""
    ordered = df.orderBy(*keys)
    return ordered if k is None else ordered.limit(k)
