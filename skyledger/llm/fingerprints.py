"""Document fingerprints: bottom-k sketches of hashed word shingles.

A sketch holds the ``K`` smallest of the hashes of a text's distinct 5-word shingles (A-Z
lower-cased; the whole sequence if there are fewer words). The sketch of a union is the ``K``
smallest of its parts' sketches, so sketches merge across the parts of a long text, and ``merged``
merges them across rows. Two sketches estimate the resemblance of their sets, how much of one is
contained in the other, and one sketch the number of its set's members; up to ``K`` members all
of these are exact.

``fingerprints`` holds each document against its own edited text, whose last floor(n / 2) code
points are replaced by the first of the next document. Documents follow each other by falling
doc_id, null last, then by hash and bytes of the text; after the last comes the first. No task orders
all: a bottom-hash sample of ids, ``PER_BUCKET`` for each bucket, sets bounds, texts are dealt to
buckets in one shuffle, and the first document of each bucket is also dealt to the bucket before
it. The bounds decide only where the cuts lie, not the result.

Defined cases: null text is empty; empty sets are equal to each other (likeness 1) and unlike all
others (0); a text longer than a slice is worked through in parts that overlap by a shingle less a
word; rows of one id follow each other like other documents; a single document is its own next;
doc_id must be castable to bigint; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.text import (
    LOWER,
    SLICE_BYTES,
    Slice,
    Words,
    gram_hashes,
    signed,
    slices,
)
from skyledger.session import drop_paths, write_shared

SHINGLE = 5
#: Hashes in a sketch: resemblance is estimated with a standard error of at most 1/16.
K = 64
#: Sampled ids from which the first one of a bucket is taken.
PER_BUCKET = 32

# Sketches of a slice: row and hash, sorted by both.
Rows = tuple[np.ndarray, np.ndarray]


def _distinct(row: np.ndarray, value: np.ndarray, k: int) -> Rows:
    """The ``k`` smallest distinct values of each row."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[first], value[first]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], value[place < k]


def _of_slice(part: Slice, k: int) -> Rows:
    words = Words(part)
    hashes = words.identities(LOWER[part.data])
    starts = words.gram_starts(SHINGLE)
    rows, found = [words.row[starts]], [gram_hashes(hashes, SHINGLE)[starts]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(words.counts == size)
        rows.append(short)
        found.append(gram_hashes(hashes, size)[words.begin[:-1][short]])
    return _distinct(np.concatenate(rows), np.concatenate(found), k)


def _pieces(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A long text in parts of about ``size`` bytes that together hold each of its shingles."""
    at, to = 0, 0
    while to < len(data):
        to = min(max(to, at) + size, len(data))
        while to < len(data) and data[to] not in (9, 10, 11, 12, 13, 32):
            to += 1
        piece = data[at:to]
        words = Words(Slice(0, piece, np.array([0, len(piece)])))
        if len(words) < SHINGLE and to < len(data):
            continue  # too few words as yet: go on from the same start
        yield piece
        if len(words) >= SHINGLE:
            at += int(words.start[1 - SHINGLE])


def sketch(texts: pa.Array, k: int = K, size: int = SLICE_BYTES) -> Rows:
    """(row, hash) of the sketches of some texts, sorted by both; null counts as empty."""
    rows, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for part in slices(texts, size):
        if len(part.data) <= 2 * size:
            row, value = _of_slice(part, k)
        else:
            row, value = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            for piece in _pieces(part.data, size):
                # A last piece of fewer words than a shingle has none that the others lack.
                own = Slice(0, piece, np.array([0, len(piece)]))
                if len(row) and len(Words(own)) < SHINGLE:
                    continue
                more = _of_slice(own, k)
                row, value = _distinct(*map(np.concatenate, zip((row, value), more)), k)
        rows.append(row + part.first)
        values.append(value)
    return np.concatenate(rows), np.concatenate(values)


def likeness(a: Rows, b: Rows, n: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """For n pairs of sketches, by row: resemblance, and how much of the first is in the second.

    The first is estimated from the ``k`` smallest hashes of the union, the second from the first
    sketch's hashes up to the end of both sketches; where there is none it is 0.
    """
    row = np.concatenate([a[0], b[0]])
    value, side = np.concatenate([a[1], b[1]]), np.repeat([0, 1], [len(a[0]), len(b[0])])
    order = np.lexsort((side, value, row))
    row, value, side = row[order], value[order], side[order]
    same = np.zeros(len(row), bool)
    same[1:] = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
    new = ~same
    begin = np.searchsorted(row, np.arange(n))
    count = np.cumsum(new)
    before = np.concatenate([[0], count])[begin]
    within = count - before[row] <= k  # among the k smallest of the union
    total = np.bincount(row[new & within], minlength=n)
    shared = np.bincount(row[same & within], minlength=n)
    known = value <= np.minimum(_end(a, n, k), _end(b, n, k))[row]
    own = np.bincount(row[known & (side == 0)], minlength=n)
    held = np.bincount(row[known & same], minlength=n)
    ratio = lambda x, y, empty: np.where(empty, 1.0, x / np.maximum(y, 1))
    return (
        ratio(shared, total, np.bincount(row, minlength=n) == 0),
        ratio(held, own, np.bincount(a[0], minlength=n) == 0),
    )


def _end(a: Rows, n: int, k: int) -> np.ndarray:
    """The hash up to which each sketch holds all of its set's."""
    end = np.zeros(n, np.uint64)
    end[a[0]] = a[1]  # sorted, so the last one stays
    end[np.bincount(a[0], minlength=n) < k] = ~np.uint64(0)
    return end


def sizes(a: Rows, n: int, k: int = K) -> np.ndarray:
    """Estimated number of members of each sketch's set; exact below ``k``."""
    held = np.bincount(a[0], minlength=n)
    end = _end(a, n, k).astype(float) + 1.0
    return np.where(held < k, held, (k - 1) * 2.0**64 / end)


def _texts(a: Rows, n: int) -> list[str]:
    """Each sketch as hexadecimal digits, 16 a hash, rising."""
    data, ends = a[1].astype(">u8").tobytes(), np.cumsum(np.bincount(a[0], minlength=n)) * 8
    return [data[x:y].hex() for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]


def document_sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id and sketch (sorted array of bigint, as unsigned) of each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, value = sketch(batch.column(1), k)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(value)))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(own, f"doc_id {kind}, sketch array<bigint>")


def merged(sketches: DataFrame, *keys: str, k: int = K) -> DataFrame:
    """One sketch for each group of ``keys``: that of the union of its rows' sets.

    No group meets in one task: equal hashes are combined and only the ``k`` smallest of a task's
    rows are dealt. Groups whose sketches all are empty have no row.
    """
    # As unsigned numbers: flipping the top bit keeps their order in signed ones.
    value = F.col("hash").bitwiseXOR(F.lit(-(1 << 63))).alias("value")
    hashes = sketches.select(*keys, F.explode("sketch").alias("hash")).select(*keys, value)
    order = Window.partitionBy(*keys).orderBy("value")
    lowest = hashes.distinct().withColumn("place", F.row_number().over(order)).where(f"place <= {k}")
    back = F.transform(
        F.sort_array(F.collect_list("value")), lambda v: v.bitwiseXOR(F.lit(-(1 << 63)))
    )
    return lowest.groupBy(*keys).agg(back.alias("sketch"))


def estimates(first: Column, second: Column, k: int = K) -> Column:
    """resemblance, containment (of the first) and n_first of two sketch columns, as a struct."""

    @F.arrow_udf("resemblance double, containment double, n_first double")
    def judge(a: pa.Array, b: pa.Array) -> pa.Array:
        own, other = (_rows(x) for x in (a, b))
        found = (*likeness(own, other, len(a), k), sizes(own, len(a), k))
        return pa.StructArray.from_arrays(
            [pa.array(x, pa.float64()) for x in found], ["resemblance", "containment", "n_first"]
        )

    return judge(first, second)


def _rows(column: pa.Array) -> Rows:
    """A column of sketches as (row, hash); null is empty."""
    column = column.fill_null([])
    counts = np.diff(column.offsets.to_numpy())
    value = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return np.repeat(np.arange(len(column)), counts), value


Place = tuple[bool, int, int]


def _place(doc_id: int | None, text_hash: int) -> Place:
    """Sorts as documents follow each other."""
    return doc_id is None, -(doc_id or 0), text_hash


def _bounds(docs: DataFrame, buckets: int) -> list[Place]:
    """Where buckets begin: the first document of all, and some of the sampled ones."""
    spark = docs.sparkSession
    ids, path = write_shared(docs.select("doc_id", F.xxhash64("text").alias("text_hash")), "ids")
    spread = F.xxhash64("doc_id", "text_hash")
    sample = ids.orderBy(spread, "doc_id", "text_hash").limit(buckets * PER_BUCKET).collect()
    first = ids.orderBy(F.col("doc_id").desc_nulls_last(), "text_hash").limit(1).collect()
    drop_paths(spark, [path])
    places = sorted({_place(*r) for r in sample})
    step = max(1, -(-len(places) // buckets))
    return sorted({_place(*r) for r in first} | set(places[::step]))


def _in_order(docs: DataFrame) -> DataFrame:
    """bucket, borrowed, doc_id, text: buckets whole and sorted, each followed by the next's first."""
    spark = docs.sparkSession
    parts = max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = _bounds(docs, parts)
    starts, n = set(bounds), len(bounds)

    @F.arrow_udf("array<int>")
    def buckets(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        """The bucket of a row and, if a bucket begins with it, the bucket before as well."""
        found = []
        for place in map(_place, ids.to_pylist(), hashes.to_pylist()):
            own = bisect_right(bounds, place) - 1
            found.append([own, (own - 1) % n] if place in starts else [own])
        return pa.array(found, pa.list_(pa.int32()))

    dealt = docs.withColumn("text_hash", F.xxhash64("text"))
    dealt = dealt.select(
        "doc_id", "text", "text_hash", F.posexplode(buckets("doc_id", "text_hash"))
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash"), F.col("text")]
    return (
        dealt.select("doc_id", "text", "text_hash", F.col("pos").alias("borrowed"),
                     F.col("col").alias("bucket"))
        .repartitionById(parts, "bucket")
        .sortWithinPartitions("bucket", "borrowed", *order)
        .select("bucket", "borrowed", "doc_id", "text")
    )


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    estimates: ``shingles`` (distinct ones) and ``kept_share`` (of them, those in the edited text).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        """(ids, texts) of some rows in order, each followed by its next; the last is only that."""
        ids, texts, bucket = [], [], None
        for batch in batches:
            for part in slices(batch.column(3)):
                rows = batch.slice(part.first, len(part)).to_pydict()
                for b, borrowed, d, text in zip(*rows.values()):
                    if b == bucket:
                        ids.append(d)
                        texts.append(text)
                        if borrowed:
                            yield ids, texts
                            bucket = None
                    elif not borrowed:
                        ids, texts, bucket = [d], [text], b
                if bucket is not None and len(ids) > 1:
                    yield ids, texts
                    ids, texts = ids[-1:], texts[-1:]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in pairs(batches):
            own, following = texts[:-1], texts[1:]
            n = len(own)
            edited = [t[: len(t) - len(t) // 2] + u[: len(t) // 2] for t, u in zip(own, following)]
            row, value = sketch(pa.array(texts, pa.large_string()), k)
            a = row[row < n], value[row < n]
            b = row[row > 0] - 1, value[row > 0]
            c = sketch(pa.array(edited, pa.large_string()), k)
            near_edited, kept = likeness(a, c, n, k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[:-1], pa.int64()),
                    pa.array([len(t) for t in own], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                    pa.array(_texts(a, n), pa.string()),
                    pa.array(_texts(c, n), pa.string()),
                    pa.array(near_edited),
                    pa.array(likeness(a, b, n, k)[0]),
                    pa.array(sizes(a, n, k).astype(float)),
                    pa.array(kept),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next", "shingles", "kept_share"],
            )

    whole = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    found = _in_order(whole).mapInArrow(
        measure,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double, shingles double,"
        " kept_share double",
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
