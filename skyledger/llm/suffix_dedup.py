"""Exact substring duplicates: runs of windows grouped by digests, in place of a radix sort.

Suffixes are compared through 400 bytes only. None are ordered, and no digits are cut from the
left: a few passes part them into groups by keys and digests; a group of one is finished, and the
groups left after the last pass are exactly the repeated windows. What a pass compares lies
around the window's anchor (see ``runs``), which equal windows have at the same offset, so
neighbouring suffixes move through the first passes as one run:

1. the anchor's 100 bytes; runs whose anchor occurs once are finished. Runs with equal hulls
   are repeated throughout and need no further digit; one of each goes on as a partner;
2. the core that 32 neighbouring windows have in common, 369 bytes;
3. the margins to the left and right of the core: what four neighbours have in common, then
   the rest of each window by itself.

Every pass counts equal keys with a combine before the shuffle, so a passage or a group of
copies that fills a third of the input is a count, not a group in one task. Further occurrences
need no join back: a run that hit the first pass and is not the only one of its hull is repeated.

Defined cases: null text is empty; texts shorter than a window lose nothing; windows do not
cross documents; two rows equal in id and text repeat each other; other columns are ignored by
``span_digests`` and kept by ``remove_repeats``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skyledger.llm import doubling_dedup, runs
from skyledger.llm.prune import hits
from skyledger.llm.text import Slice, SpanHash, signed, slices
from skyledger.session import drop_paths, write_shared

WINDOW = 400
ANCHOR = 100
#: Neighbouring windows that share a core in the second pass, and in the passes after it.
WIDTHS = (32, 4, 1)
NEAR = WIDTHS[0]


def _measure(part: Slice, window: int = WINDOW, anchor: int = ANCHOR) -> runs.Runs:
    """The runs of a slice, in bytes."""
    grams = SpanHash(part.data).grams(anchor)
    return runs.find_runs(memoryview(part.data), None, grams, part.offsets, window, anchor)


def _cores(
    docs: DataFrame, measure: runs.Measure, found: Broadcast, bits: Broadcast, lone: Broadcast
) -> DataFrame:
    """The open runs in parts of ``NEAR`` offsets: digest of the core, margins left and right.

    ``lone`` marks the runs that are the only ones of their hull; the others are known to repeat.
    """
    names = ["core_a", "core_b", "l0", "doc_order", "text_hash", "at", "lo", "hi", "lone", "left",
             "right"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(2).to_numpy()
            for part in slices(batch.column(0)):
                own = measure(part)
                own = runs.open_runs(own, hashes[part.first :], bits, found)
                single = hits(runs.identity(own, hashes[part.first :]), lone.value)
                lowest, highest = own.anchor - own.last, own.anchor - own.first
                n = highest // NEAR - lowest // NEAR + 1
                index = np.repeat(np.arange(len(n)), n)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                l0 = (lowest[index] // NEAR + step) * NEAR
                lo, hi = np.maximum(lowest[index], l0), np.minimum(highest[index], l0 + NEAR - 1)
                at = own.anchor[index]
                core = own.digests(at - l0, at - l0 - NEAR + 1 + own.window, l0)
                data = part.data.tobytes()
                left = zip((at - hi).tolist(), (at - l0).tolist(), strict=True)
                right = zip((at - l0 - NEAR + 1 + own.window).tolist(),
                            (at - lo + own.window).tolist(), strict=True)
                rows = pa.array(own.row[index] + part.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core[:, 0]),
                        pa.array(core[:, 1]),
                        pa.array(l0.astype(np.int32)),
                        batch.column(1).take(rows),
                        batch.column(2).take(rows),
                        pa.array(at - part.offsets[own.row[index]]),
                        pa.array(lo.astype(np.int32)),
                        pa.array(hi.astype(np.int32)),
                        pa.array(single[index]),
                        pa.array([data[a:b] for a, b in left], pa.binary()),
                        pa.array([data[a:b] for a, b in right], pa.binary()),
                    ],
                    names=names,
                )

    return docs.select("text", "doc_order", "text_hash").mapInArrow(
        scan,
        "core_a bigint, core_b bigint, l0 int, doc_order bigint, text_hash bigint, at bigint,"
        " lo int, hi int, lone boolean, left binary, right binary",
    )


KEY = ["core_a", "core_b", "l0", "before", "after"]
PART = [*KEY, "lo", "hi", "left", "right"]


def _split(parts: DataFrame, width: int, narrower: int) -> DataFrame:
    """Parts of ``width`` offsets as parts of fewer: what these share of the margins joins the key."""
    offset = F.floor(F.col("lo") / narrower).cast("int") * narrower
    return (
        parts.withColumn("s0", F.explode(F.sequence(offset, F.col("hi"), F.lit(narrower))))
        .withColumn("s1", F.col("s0") + narrower - 1)
        .withColumn("l1", F.col("l0") + width - 1)
        .withColumns({"lo2": F.greatest("lo", "s0"), "hi2": F.least("hi", "s1")})
        .select(
            "core_a",
            "core_b",
            F.col("s0").alias("l0"),
            F.expr("concat(substring(left, hi - s0 + 1, s0 - l0), before)").alias("before"),
            F.expr("concat(after, substring(right, 1, l1 - s1))").alias("after"),
            F.col("lo2").alias("lo"),
            F.col("hi2").alias("hi"),
            F.expr("substring(left, hi - hi2 + 1, hi2 - s0)").alias("left"),
            F.expr("substring(right, l1 - s1 + 1, s1 - lo2)").alias("right"),
            "doc_order",
            "text_hash",
            "at",
            "lone",
        )
    )


def _spans_of_cores(cores: DataFrame, window: int) -> DataFrame:
    """Repeated stretches (doc_order, text_hash, start, end) of the passes after the first."""
    nothing = F.lit(b"")
    parts, found = cores.withColumns({"before": nothing, "after": nothing}), []
    for width, narrower in zip(WIDTHS, [*WIDTHS[1:], 0], strict=True):
        groups = parts.groupBy(*PART).agg(
            F.count("*").alias("n"),
            F.min(F.struct("doc_order", "text_hash", "at")).alias("first"),
            F.some("lone").alias("lone"),
        )
        equal = parts.where("lone").join(groups.where("n > 1").select(*PART), PART)
        found.append(
            equal.select(
                "doc_order",
                "text_hash",
                (F.col("at") - F.col("hi")).alias("start"),
                (F.col("at") - F.col("lo") + window).alias("end"),
            )
        )
        if narrower:
            settled = F.every(F.expr("n > 1 OR NOT lone"))
            keys = (
                groups.groupBy(*KEY)
                .agg(F.count("*").alias("parts"), settled.alias("settled"))
                .where("parts > 1 AND NOT settled")
                .select(*KEY)
            )
            opened = groups.join(keys, KEY).select(*PART, "first.*", "lone")
            parts, _ = write_shared(_split(opened, width, narrower), "parts")
    return reduce(DataFrame.union, found)


def repeats(
    docs: DataFrame, window: int, anchor: int, words: int = 0
) -> tuple[DataFrame, Broadcast, Broadcast | None]:
    """``docs`` with the lists that ``runs.stretches`` takes, and the bitmap of repeated keys.

    With ``words``, also the lists and the bitmap of windows of so many words. ``docs`` has the
    columns of ``runs.documents`` and may have more.
    """
    measure = partial(_measure, window=window, anchor=anchor)
    found = runs.key_bits(docs, measure)
    groups, groups_path = runs.hull_groups(docs, measure, found)
    bits, lone_bits = runs.open_bits(groups, F.col("n") > 1)
    cores, cores_path = write_shared(_cores(docs, measure, found, bits, lone_bits), "cores")
    span = F.struct("start", "end")
    spans, spans_path = write_shared(
        runs.by_document(_spans_of_cores(cores, window), span, "spans"), "spans"
    )
    lone = groups.where("n = 1").select("first.*")
    lists = [runs.by_document(lone, F.col("place"), "places"), spans]
    paths, found_words = [groups_path, cores_path, spans_path], None
    if words:
        *more, found_words, more_paths = doubling_dedup.all_repeats(docs, words)
        lists, paths = lists + more, paths + more_paths
    listed = runs.with_lists(docs, *lists)
    drop_paths(docs.sparkSession, paths)
    return listed, found, found_words


def _stretches(
    texts: pa.Array, places: pa.Array, spans: pa.Array, measure: runs.Measure, found: Broadcast
) -> Iterator[tuple]:
    """(bytes, starts, ends) of each text with its lists."""
    for part in slices(texts):
        own = measure(part)
        own = own.pick(hits(signed(own.key), found.value))
        lists = (x.slice(part.first, len(part)) for x in (places, spans))
        for i, (starts, ends) in enumerate(runs.stretches(own, len(part), *lists)):
            yield part.data[part.offsets[i] : part.offsets[i + 1]], starts, ends


def _kept(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    keep = np.ones(len(data), bool)
    for a, b in zip(starts, ends, strict=True):
        keep[a:b] = False
    return keep


def span_digests(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    listed, found, _ = repeats(runs.documents(docs), window, anchor)
    measure = partial(_measure, window=window, anchor=anchor)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, sha = [], [], [], []
            for data, starts, ends in _stretches(*batch.columns[:3], measure, found):
                n_bytes.append(len(data))
                n_removed.append(int((ends - starts).sum()))
                n_spans.append(len(starts))
                kept = data[_kept(data, starts, ends)] if len(starts) else data
                sha.append(hashlib.sha256(np.ascontiguousarray(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)),
                 pa.array(sha, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return listed.select("text", "places", "spans", "doc_id").mapInArrow(
        digest,
        f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    )


def _without(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """The text without its stretches; a character goes if any of its bytes does."""
    if not len(starts):
        return data.tobytes().decode()
    keep, lead = _kept(data, starts, ends), (data & 0xC0) != 0x80
    whole = np.logical_and.reduceat(keep, np.flatnonzero(lead))
    return data[whole[np.cumsum(lead) - 1]].tobytes().decode()


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, words: int = 0
) -> DataFrame:
    """``docs`` with all columns, the repeated windows cut out of ``text``; null stays null.

    With ``words``, repeated windows of so many words go as well, whatever their bytes, from the
    first word to the end of the last; both kinds are found in the whole texts.
    """
    own = F.struct(*docs.columns).alias("own")
    known = runs.documents(docs.withColumn("__own", own), "__own")
    listed, found, found_words = repeats(known, window, anchor, words)
    measure = partial(_measure, window=window, anchor=anchor)

    @F.arrow_udf(StringType())
    def cut(texts: pa.Array, places: pa.Array, spans: pa.Array, *more: pa.Array) -> pa.Array:
        rows = _stretches(texts, places, spans, measure, found)
        if words:
            others = doubling_dedup.byte_stretches(texts, *more, words, found_words)
            pairs = zip(rows, others, strict=True)
            rows = ((data, *map(np.concatenate, zip(x, y))) for (data, *x), y in pairs)
        return pa.array([_without(*x) for x in rows], pa.string())

    lists = ["places", "spans", *(["word_places", "word_spans"] if words else [])]
    left = cut(F.col("text"), *map(F.col, lists))
    text = F.when(F.col("__own.text").isNotNull(), F.col("cut")).alias("text")
    return listed.select("__own", left.alias("cut")).select(
        *(text if c == "text" else F.col(f"__own.`{c}`") for c in docs.columns)
    )
