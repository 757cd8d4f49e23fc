"""Uniform random samples of a fixed size."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` random rows, or every row if there are fewer.

    A row count gives the share to keep, with a margin of six standard
    deviations above ``n``; every task then passes on only its part of that,
    and the last step orders those few rows at random and takes ``n``.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    margin = n + 6 * sqrt(n) + 20
    kept = df.filter(F.rand(seed) * total < F.lit(float(margin)))
    return kept.orderBy(F.rand(seed + 1)).limit(n)


def row_hash(columns: tuple[str, ...] | list[str]) -> Column:
    """md5 of some columns of a row as text; numbers count as whole, null as ``~``."""

    def text(name: str) -> Column:
        return F.coalesce(F.expr(f"CAST(`{name}` AS STRING)"), F.lit("~"))

    return F.md5(F.concat_ws("|", *[text(c) for c in columns]))
