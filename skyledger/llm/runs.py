"""Repeated windows of texts: the parts that byte windows and word windows share.

A window is a fixed number of consecutive units (bytes or words) of one document. Equal windows
have equal lowest-hashed grams (a gram is a short run of units) at equal offsets, so windows
are not handled one by one: neighbours with the same lowest gram, their anchor, form a run
(document, anchor ``at``, offsets ``lo`` to ``hi``): the windows that begin at ``at - hi`` to
``at - lo``. Two equal windows lie in runs with equal anchor hashes (``key``), and runs with
equal hulls (all units from the first window's start to the last one's end) are equal throughout.

Texts stay where they are. Each pass scans them anew, recomputes the runs and picks those that
hit a bitmap of fixed size made from the pass before; only narrow rows about them are shuffled:

1. keys are counted; a run whose key occurs once is finished;
2. of the others, hulls are grouped: n occurrences, and the first of them;
3. firsts whose key has another hull are open: their windows are compared one by one, by each
   operator in its own way;
4. each document gets the places of its firsts and of its single windows. What else of it hit the
   bitmap of step 1 is a further occurrence, without any join.

A run that hits a bitmap by chance is a true run of its document: it is the first and only one of
its hull, and its windows are compared with the others as they should.

A document is known by (doc_id, text_hash), so rows that repeat an id with another text stay
apart. A null id comes last in the order of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.prune import bitmap_array, hits, key_bitmap, may_have, surely_not
from skyledger.llm.text import Slice, signed, sliding_min, slices
from skyledger.session import drop_paths, write_shared

_POSITION = np.uint64(0xFFFFFFFF)
#: A place is at, hi and lo in one number: 43, 10 and 10 bits.
_OFFSET = 10


@dataclass
class Runs:
    """Runs of the rows of a slice, by unit of the whole slice.

    ``data`` holds the bytes of the units, which are single bytes or, with ``spans``, stretches
    that begin and end there; ``begin`` is the first unit of each row.
    """

    data: memoryview
    spans: tuple[np.ndarray, np.ndarray] | None
    window: int
    begin: np.ndarray
    row: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray

    def pick(self, chosen: np.ndarray) -> Runs:
        parts = (x[chosen] for x in (self.row, self.anchor, self.first, self.last, self.key))
        return Runs(self.data, self.spans, self.window, self.begin, *parts)

    @property
    def place(self) -> np.ndarray:
        """at, hi and lo of each run in one number, within its row."""
        at = self.anchor - self.begin[self.row]
        offsets = (self.anchor - self.first) << _OFFSET | (self.anchor - self.last)
        return at << 2 * _OFFSET | offsets

    def digests(self, start: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """128 bits of the bytes of each stretch of units and its seed, as two columns."""
        if self.spans:
            start, end = self.spans[0][start], self.spans[1][end - 1]
        places = zip(start.tolist(), end.tolist(), seeds.tolist(), strict=True)
        view = self.data
        found = b"".join([xxhash.xxh3_128_digest(view[a:b], seed) for a, b, seed in places])
        return np.frombuffer(found, "<i8").reshape(-1, 2)

    def hulls(self) -> np.ndarray:
        """Digests of the hulls together with their offsets."""
        offsets = self.place & ((1 << 2 * _OFFSET) - 1)
        return self.digests(self.first, self.last + self.window, offsets)


def find_runs(
    data: memoryview,
    spans: tuple[np.ndarray, np.ndarray] | None,
    grams: np.ndarray,
    begin: np.ndarray,
    window: int,
    gram: int,
) -> Runs:
    """All runs of a slice. ``grams`` has the hash of each gram by its first unit.

    Of equally low grams the first is the anchor.
    """
    counts = np.maximum(np.diff(begin) - window + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return Runs(data, spans, window, begin, none, none, none, none, none.view(np.uint64))
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(total) + np.repeat(begin[:-1] - (np.cumsum(counts) - counts), counts)
    places = np.arange(len(grams), dtype=np.uint64)
    low = sliding_min((grams & ~_POSITION) | places, window - gram + 1)
    anchor = (low[start] & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.append(first[1:], total) - 1
    at = anchor[first]
    return Runs(data, spans, window, begin, row[first], at, start[first], start[last], grams[at])


Measure = Callable[[Slice], Runs]
DOC_ORDER = "ifnull(CAST(doc_id AS bigint), 9223372036854775807)"


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """doc_order, text_hash, doc_id, text and ``more``. A null id has the highest order."""
    return docs.select(
        F.expr(DOC_ORDER).alias("doc_order"),
        F.xxhash64("text").alias("text_hash"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        *more,
    )


def key_bits(docs: DataFrame, measure: Measure) -> Broadcast:
    """Bitmap of the keys that occur at least twice."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                key = pa.array(signed(measure(part).key))
                yield pa.RecordBatch.from_arrays([key], names=["key"])

    keys = docs.select("text").mapInArrow(scan, "key bigint")
    repeated = keys.groupBy("key").count().where("count > 1")
    return bitmap_array(repeated, F.col("key"))


HULL = ["hull_a", "hull_b"]


def hull_groups(docs: DataFrame, measure: Measure, bits: Broadcast) -> tuple[DataFrame, str]:
    """One row for each hull: n occurrences, key, and ``first`` (doc_order, text_hash, place).

    Written to shared storage. A group of any size is combined before the shuffle.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                runs = measure(part)
                runs = runs.pick(hits(signed(runs.key), bits.value))
                hull, rows = runs.hulls(), pa.array(runs.row + part.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(rows),
                        batch.column(2).take(rows),
                        pa.array(runs.place),
                        pa.array(signed(runs.key)),
                        pa.array(hull[:, 0]),
                        pa.array(hull[:, 1]),
                    ],
                    names=["doc_order", "text_hash", "place", "key", *HULL],
                )

    found = docs.select("text", "doc_order", "text_hash").mapInArrow(
        scan,
        "doc_order bigint, text_hash bigint, place bigint, key bigint, hull_a bigint,"
        " hull_b bigint",
    )
    groups = found.groupBy(*HULL).agg(
        F.count("*").alias("n"),
        F.max("key").alias("key"),
        F.min(F.struct("doc_order", "text_hash", "place")).alias("first"),
    )
    return write_shared(groups, "hulls")


def open_bits(groups: DataFrame, settled: Column) -> tuple[Broadcast, Broadcast]:
    """Bitmaps of the firsts whose key has another hull, and of those alone in their hull.

    Keys all of whose hulls are ``settled`` are left out.
    """
    keys = (
        groups.groupBy("key")
        .agg(F.count("*").alias("hulls"), F.every(settled).alias("settled"))
        .where("hulls > 1 AND NOT settled")
    )
    bitmap, path = key_bitmap(keys, F.col("key"))
    opened = may_have(groups, F.col("key"), bitmap)
    own = F.expr("hull_a ^ first.text_hash ^ first.place")
    bits = bitmap_array(opened, own), bitmap_array(opened.where("n = 1"), own)
    drop_paths(groups.sparkSession, [path])
    return bits


def identity(runs: Runs, text_hash: np.ndarray) -> np.ndarray:
    """What the bitmaps of ``open_bits`` know a run by; ``text_hash`` by row."""
    return runs.hulls()[:, 0] ^ text_hash[runs.row] ^ runs.place


def open_runs(runs: Runs, text_hash: np.ndarray, bits: Broadcast, found: Broadcast) -> Runs:
    """The open runs of a slice."""
    runs = runs.pick(hits(signed(runs.key), found.value))
    return runs.pick(hits(identity(runs, text_hash), bits.value))


def by_document(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Values of rows (doc_order, text_hash, ...) gathered for each document.

    There are never more than the document has windows.
    """
    return rows.groupBy("doc_order", "text_hash").agg(F.collect_list(value).alias(name))


def stretched(windows: DataFrame, window: int) -> DataFrame:
    """Rows (doc_order, text_hash, start) of windows as stretches (.., start, end) of those that meet."""
    own = ["doc_order", "text_hash"]
    in_order = Window.partitionBy(*own).orderBy("start")
    before = F.lag("start").over(in_order)
    begins = F.coalesce(F.col("start") - before > window, F.lit(True)).cast("int")
    return (
        windows.withColumn("begins", begins)
        .withColumn("stretch", F.sum("begins").over(in_order))
        .groupBy(*own, "stretch")
        .agg(F.min("start").alias("start"), (F.max("start") + window).alias("end"))
        .drop("stretch")
    )


def with_lists(docs: DataFrame, *lists: DataFrame) -> DataFrame:
    """``docs`` with the ``lists`` (places, spans) of each document, null where it has none.

    Documents that have none do not move: a bitmap of the others tells most of them.
    """
    own = ["doc_order", "text_hash"]
    joined = reduce(lambda a, b: a.join(b, own, "full"), lists)
    lists, _ = write_shared(joined, "document-lists")
    bitmap, _ = key_bitmap(lists, F.xxhash64(*own))
    moved = may_have(docs, F.xxhash64(*own), bitmap).hint("merge").join(lists, own, "left")
    others = surely_not(docs, F.xxhash64(*own), bitmap)
    return moved.unionByName(others, allowMissingColumns=True)


def stretches(runs: Runs, rows: int, places: pa.Array, spans: pa.Array) -> Iterator[tuple]:
    """Per row of a slice the merged (starts, ends), in units, of what repeats.

    These are the runs that are not at one of ``places``, and the ``spans`` (start, end).
    """
    place, bound = runs.place, np.searchsorted(runs.row, np.arange(rows + 1))
    at = runs.anchor - runs.begin[runs.row]
    start = at - (runs.anchor - runs.first)
    end = at - (runs.anchor - runs.last) + runs.window
    kept, singles = places.fill_null([]), spans.fill_null([])
    kept_values, kept_ends = kept.values.to_numpy(), kept.offsets.to_numpy()
    span_ends = singles.offsets.to_numpy()
    span_start, span_end = (x.to_numpy(zero_copy_only=False) for x in singles.values.flatten())
    for i in range(rows):
        a, b = bound[i], bound[i + 1]
        c, d = span_ends[i], span_ends[i + 1]
        own = kept_values[kept_ends[i] : kept_ends[i + 1]]
        more = ~np.isin(place[a:b], own) if len(own) else np.ones(b - a, bool)
        yield merged(
            np.concatenate([start[a:b][more], span_start[c:d]]),
            np.concatenate([end[a:b][more], span_end[c:d]]),
        )


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching stretches as maximal ones."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[first], reach[np.append(np.flatnonzero(first)[1:], len(starts)) - 1]
