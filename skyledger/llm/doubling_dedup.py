"""Repeated word windows by level-wise doubling; all but the first occurrence go.

Level 5: every window of 20 words has an anchor, its lowest-hashed 5 words (see ``runs``); windows
whose anchor occurs once are finished. Runs of windows with equal hulls are repeated throughout:
all but the first of these runs go as a whole, and the first goes on as their representative.
Level 10: what is left is extended to the 10 words that begin at the anchor, or that end the
window where the anchor lies late in it; stretches that occur once are finished. Level 20: the
rest is extended to the whole window; of equal windows all but the earliest go. Nothing survives
longer than that, because a window of 20 words is all that counts.

The earliest occurrence of a window is always in a representative: the first run with the same
hull contains it too. Documents are ordered by doc_id, null last, then by text. A run that hit
the first level and is not the first of its hull goes without any join.

Defined cases: null text and texts without words have no windows, and nothing is removed; rows
equal in id and text count as one document, so none of them repeats another; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import runs
from skyledger.llm.prune import hits, key_bitmap, may_have
from skyledger.llm.text import Slice, Words, gram_hashes, signed, slices
from skyledger.session import drop_paths, write_shared

WINDOW = 20


def _measure(part: Slice, window: int = WINDOW) -> runs.Runs:
    """The runs of a slice, in words."""
    return _measured(part, Words(part), window)


def _measured(part: Slice, words: Words, window: int) -> runs.Runs:
    grams = gram_hashes(words.identities(part.data), window // 4)
    data, *spans = words.joined(part.data)
    return runs.find_runs(data, tuple(spans), grams, words.begin, window, window // 4)


def _levels(
    docs: DataFrame, found: Broadcast, bits: Broadcast, window: int
) -> DataFrame:
    """The open windows: hash of half the words, digest of all of them."""
    half = window // 2
    names = ["doc_order", "text_hash", "at", "l", "counts", "before", "half", "whole_a", "whole_b"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(2).to_numpy()
            for part in slices(batch.column(0)):
                words = Words(part)
                own = _measured(part, words, window)
                halves = gram_hashes(words.identities(part.data), half)
                own = runs.open_runs(own, hashes[part.first :], bits, found)
                n = own.last - own.first + 1
                index = np.repeat(np.arange(len(n)), n)
                start = own.first[index] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = own.anchor[index]
                before = np.maximum(at - start - half, 0)
                whole = own.digests(start, start + window, np.zeros_like(start))
                rows = pa.array(own.row[index] + part.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(rows),
                        batch.column(2).take(rows),
                        pa.array(at - own.begin[own.row[index]]),
                        pa.array((at - start).astype(np.int32)),
                        pa.array((before > 0) | (start == own.last[index])),
                        pa.array(before),
                        pa.array(signed(halves[at - before])),
                        pa.array(whole[:, 0]),
                        pa.array(whole[:, 1]),
                    ],
                    names=names,
                )

    return docs.select("text", "doc_order", "text_hash").mapInArrow(
        scan,
        "doc_order bigint, text_hash bigint, at bigint, l int, counts boolean, before bigint,"
        " half bigint,"
        " whole_a bigint, whole_b bigint",
    )


def _later_windows(windows: DataFrame, window: int) -> tuple[DataFrame, str]:
    """Stretches (doc_order, text_hash, start, end) of windows that occur earlier as well."""
    # Windows of a run that have their anchor early share one half, which counts once.
    spread = F.col("half").bitwiseXOR(F.col("before"))
    halves = windows.where("counts").groupBy("half", "before").count().where("count > 1")
    bitmap, path = key_bitmap(halves, spread)
    longer = may_have(windows, spread, bitmap)
    start = (F.col("at") - F.col("l")).alias("start")
    own = F.struct("doc_order", "text_hash", "start")
    longer = longer.select("doc_order", "text_hash", start, "whole_a", "whole_b")
    earliest = (
        longer.groupBy("whole_a", "whole_b")
        .agg(F.count("*").alias("n"), F.min(own).alias("earliest"))
        .where("n > 1")
        .drop("n")
    )
    later = (
        longer.join(earliest, ["whole_a", "whole_b"])
        .where(own > F.col("earliest"))
        .select("doc_order", "text_hash", "start")
    )
    later, later_path = write_shared(runs.stretched(later, window), "later-windows")
    drop_paths(windows.sparkSession, [path])
    return later, later_path


def later_repeats(docs: DataFrame, window: int) -> tuple[DataFrame, Broadcast]:
    """``docs`` with the lists that ``runs.stretches`` takes, and the bitmap of repeated keys."""
    measure = partial(_measure, window=window)
    found = runs.key_bits(docs, measure)
    groups, groups_path = runs.hull_groups(docs, measure, found)
    bits, _ = runs.open_bits(groups, F.lit(False))
    windows, windows_path = write_shared(_levels(docs, found, bits, window), "windows")
    later, later_path = _later_windows(windows, window)
    places = runs.by_document(groups.select("first.*"), F.col("place"), "places")
    spans = runs.by_document(later, F.struct("start", "end"), "spans")
    listed = runs.with_lists(docs, places, spans)
    drop_paths(docs.sparkSession, [groups_path, windows_path, later_path])
    return listed, found


def all_repeats(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame, Broadcast, list[str]]:
    """Lists of places and of spans, the bitmap of repeated keys, and the paths behind the lists.

    Of equal windows all count, the earliest as well: what is not at a place is repeated.
    """
    measure = partial(_measure, window=window)
    found = runs.key_bits(docs, measure)
    groups, groups_path = runs.hull_groups(docs, measure, found)
    bits, _ = runs.open_bits(groups, F.col("n") > 1)
    windows, windows_path = write_shared(_levels(docs, found, bits, window), "windows")
    whole = ["whole_a", "whole_b"]
    equal, equal_path = write_shared(
        windows.groupBy(*whole).count().where("count > 1").select(*whole), "equal-windows"
    )
    bitmap, bitmap_path = key_bitmap(equal, F.col("whole_a"))
    start = (F.col("at") - F.col("l")).alias("start")
    repeated = may_have(windows, F.col("whole_a"), bitmap).join(equal, whole)
    spans = runs.stretched(repeated.select("doc_order", "text_hash", start), window)
    lone = groups.where("n = 1").select("first.*")
    return (
        runs.by_document(lone, F.col("place"), "word_places"),
        runs.by_document(spans, F.struct("start", "end"), "word_spans"),
        found,
        [groups_path, windows_path, equal_path, bitmap_path],
    )


def byte_stretches(
    texts: pa.Array, places: pa.Array, spans: pa.Array, window: int, found: Broadcast
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, ends) of each text with its lists, in bytes from a first word to a last one."""
    for part in slices(texts):
        words = Words(part)
        own = _measured(part, words, window)
        own = own.pick(hits(signed(own.key), found.value))
        lists = (x.slice(part.first, len(part)) for x in (places, spans))
        for i, (starts, ends) in enumerate(runs.stretches(own, len(part), *lists)):
            begin, offset = words.begin[i], part.offsets[i]
            yield words.start[begin + starts] - offset, words.end[begin + ends - 1] - offset


def _kept(data: np.ndarray, words: Words, row: int, keep: np.ndarray) -> bytes:
    """The kept words of a row, joined by one space."""
    begin = words.begin[row]
    view, chosen = memoryview(data), begin + np.flatnonzero(keep)
    ends = zip(words.start[chosen].tolist(), words.end[chosen].tolist(), strict=True)
    return b" ".join([view[a:b] for a, b in ends])


def word_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    listed, found = later_repeats(runs.documents(docs), window)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha = [], [], []
            for part in slices(batch.column(0)):
                words = Words(part)
                own = _measured(part, words, window)
                own = own.pick(hits(signed(own.key), found.value))
                lists = (batch.column(i).slice(part.first, len(part)) for i in (1, 2))
                for i, (starts, ends) in enumerate(runs.stretches(own, len(part), *lists)):
                    keep = np.ones(words.counts[i], bool)
                    for a, b in zip(starts, ends, strict=True):
                        keep[a:b] = False
                    n_words.append(len(keep))
                    n_removed.append(len(keep) - int(keep.sum()))
                    sha.append(hashlib.sha256(_kept(part.data, words, i, keep)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(3),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(sha, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return listed.select("text", "places", "spans", "doc_id").mapInArrow(
        digest, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    )
