"""Keep rows out of a shuffle by a bitmap of the keys that matter.

The bitmap has a fixed size, so broadcasting it is safe for any input. A row that misses it
surely has none of the keys; one that hits it may, and a join decides. With many more keys than
bits every row hits it, and the joins do all the work.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.session import write_shared

#: 2**19 rows of 64 bits: 8 MB.
BITMAP_ROWS = 1 << 19


def _bit(key: Column) -> tuple[Column, Column]:
    """Row and bit of a 64-bit key."""
    return (
        key.bitwiseAND(F.lit(BITMAP_ROWS - 1)),
        F.shiftrightunsigned(key, 19).bitwiseAND(F.lit(63)).cast("int"),
    )


def key_bitmap(keys: DataFrame, key: Column) -> tuple[DataFrame, str]:
    """(bits_row, bits) of all values of ``key``, written to shared storage, and its path."""
    row, bit = _bit(key)
    return write_shared(
        keys.select(row.alias("bits_row"), bit.alias("bit"))
        .groupBy("bits_row")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")),
        "key-bitmap",
    )


def bitmap_array(keys: DataFrame, key: Column) -> Broadcast:
    """The bits of all values of ``key`` as a broadcast array, for tasks that scan in numpy."""
    row, bit = _bit(key)
    table = (
        keys.select(row.alias("bits_row"), bit.alias("bit"))
        .groupBy("bits_row")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(BITMAP_ROWS, np.uint64)
    bits[table["bits_row"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bits)


def hits(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of some 64-bit keys hit the array of a bitmap."""
    keys = keys.view(np.uint64)
    word = bits[keys & np.uint64(BITMAP_ROWS - 1)]
    return (word >> ((keys >> np.uint64(19)) & np.uint64(63)) & np.uint64(1)).astype(bool)


def may_have(rows: DataFrame, key: Column, bitmap: DataFrame) -> DataFrame:
    """The rows that hit the bitmap."""
    return _marked(rows, key, bitmap, "inner").where("__hit").drop("__hit")


def surely_not(rows: DataFrame, key: Column, bitmap: DataFrame) -> DataFrame:
    """The rows that miss the bitmap."""
    return _marked(rows, key, bitmap, "left").where("NOT __hit").drop("__hit")


def _marked(rows: DataFrame, key: Column, bitmap: DataFrame, how: str) -> DataFrame:
    row, bit = _bit(key)
    bits = bitmap.select(F.col("bits_row").alias("__own_row"), F.col("bits").alias("__bits"))
    return (
        rows.withColumns({"__row": row, "__bit": bit})
        .join(F.broadcast(bits), F.col("__row") == F.col("__own_row"), how)
        .withColumn("__hit", F.expr("ifnull(getbit(__bits, __bit), 0) = 1"))
        .drop("__row", "__bit", "__own_row", "__bits")
    )


def without(rows: DataFrame, dropped: DataFrame, on: Column, key: str, dropped_key: str) -> DataFrame:
    """``rows`` without those that match ``dropped`` by ``on``; others do not move.

    ``key`` and ``dropped_key`` are SQL of a 64-bit key that matching rows share.
    """
    dropped, _ = write_shared(dropped, "dropped")
    bitmap, _ = key_bitmap(dropped, F.expr(dropped_key))
    hits = may_have(rows, F.expr(key), bitmap)
    return surely_not(rows, F.expr(key), bitmap).union(hits.join(dropped, on, "left_anti"))
