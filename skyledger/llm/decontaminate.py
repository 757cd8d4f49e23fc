"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Three-word grams of the test items are counted over the whole corpus. Seeds are the grams that are
rare there (``RARE``), and in every five consecutive grams of an item the rarest, so that an item
has seeds all along even where its grams are common, as those of a leaked item are. Documents that hold a seed give passages around it; seeds
join passages to items, and tasks align each pair word by word, many pairs at once. A pair counts
if its best local alignment reaches half of what the whole item would score. Such an alignment
spans at most twice the item's words, so the reach of a passage around a seed is twice the longest
item, and no seed's alignments leave its passage. Memory is bounded by cells of the alignment:
passages are cut after ``PIECE`` reaches, however long a document is, and pairs are batched by length.

The scans test grams against a bitmap of fixed size (see ``prune``), which
a benchmark of any size can fill: beyond it more chance hits reach the joins, which drop them.

Defined cases: words are compared in lower case (A-Z); null and empty texts hold nothing; items
of fewer than ``MIN_WORDS`` words are too short to tell a copy from chance and match nothing;
null ids are ids like others, and ids are taken as bigint; very long texts are scanned and aligned
piece by piece; of equal alignments the one that ends first counts; two texts under one id count as texts of one document; rows that
repeat are reported once; other columns are ignored; with no documents or items nothing matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.prune import bitmap_array, hits, without
from skyledger.llm.runs import documents
from skyledger.llm.text import LOWER, Slice, Words, gram_hashes, signed, slices
from skyledger.session import drop_paths, write_shared

GRAM = 3
#: A gram is rare if it makes up at most this share of the corpus's words, or occurs ten times.
RARE = 2e-6
#: Of so many consecutive grams of an item the rarest is a seed in any case.
SEED_EVERY = 3
MIN_WORDS = 8
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
#: Words of texts, with padding, that are aligned at once.
CELLS = 1 << 18
#: A stretch with seeds all along is cut after so many times the reach, with a reach of overlap.
PIECE = 8

PASSAGE = "doc_id bigint, text_hash bigint, start bigint, words array<int>, seeds array<bigint>"


def _lowered(part: Slice) -> tuple[Words, np.ndarray]:
    words = Words(part)
    return words, words.identities(LOWER[part.data])


def _short(hashes: np.ndarray) -> np.ndarray:
    """32 bits of each word hash, for alignment."""
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def item_table(benchmark: DataFrame) -> DataFrame:
    """(item_key, item_id, n_words, words, grams) of the items that are long enough."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                words, hashes = _lowered(part)
                short, grams = _short(hashes), signed(gram_hashes(hashes, GRAM))
                rows = np.flatnonzero(words.counts >= MIN_WORDS)
                ends = [(words.begin[i], words.begin[i + 1]) for i in rows]
                chosen = pa.array(rows + part.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(chosen),
                        batch.column(1).take(chosen),
                        pa.array(words.counts[rows].astype(np.int64)),
                        pa.array([short[a:b] for a, b in ends], pa.list_(pa.int32())),
                        pa.array([grams[a : b - GRAM + 1] for a, b in ends], pa.list_(pa.int64())),
                    ],
                    names=["item_key", "item_id", "n_words", "words", "grams"],
                )

    return (
        benchmark.select(F.xxhash64("item_id", "text").alias("item_key"), "item_id", "text")
        .dropDuplicates(["item_key"])
        .mapInArrow(
            run,
            f"item_key bigint, item_id {kind}, n_words bigint, words array<int>,"
            " grams array<bigint>",
        )
    )


def gram_counts(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, n): how often each value of ``grams`` (column gram) occurs in all documents.

    Under a null gram n is the number of all words.
    """
    bits = bitmap_array(grams, F.col("gram"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                words, hashes = _lowered(part)
                found = gram_hashes(hashes, GRAM)[words.gram_starts(GRAM)]
                found, n = np.unique(found[hits(found, bits.value)], return_counts=True)
                gram = pa.array([None, *signed(found).tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [gram, pa.array([len(words), *n.tolist()], pa.int64())], names=["gram", "n"]
                )

    counts = docs.select("text").mapInArrow(run, "gram bigint, n bigint")
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))


def seeds(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(gram, item_key): the rare grams of the items, and the rarest of every ``SEED_EVERY``."""
    placed = items.select("item_key", F.posexplode("grams").alias("place", "gram"))
    counts, _ = write_shared(gram_counts(docs, placed.select("gram")), "gram-counts")
    total = counts.where("gram IS NULL").first()
    enough = max(10, RARE * (total.n if total else 0))
    # Counts of the same magnitude are ties, so that edited copies do not sway the choice.
    known = placed.join(counts, "gram", "left").withColumns(
        {"n": F.coalesce("n", F.lit(0)), "rank": F.expr("struct(floor(log2(ifnull(n, 0) + 1)), gram)")}
    )
    ahead = Window.partitionBy("item_key").orderBy("place").rowsBetween(0, SEED_EVERY - 1)
    rarest = known.withColumns(
        {
            "rarest": F.min("rank").over(ahead),
            "last": F.max("place").over(Window.partitionBy("item_key")),
        }
    )
    full = F.col("place") <= F.greatest(F.col("last") - SEED_EVERY + 1, F.lit(0))
    rare = F.col("n") <= enough
    return (
        rarest.where(full)
        .select("rarest.gram", "item_key")
        .union(rarest.where(rare).select("gram", "item_key"))
        .distinct()
    )


def passages(docs: DataFrame, keys: DataFrame, reach: int) -> DataFrame:
    """Stretches of documents within ``reach`` words of a seed, with the seeds they hold."""
    bits = bitmap_array(keys, F.col("gram"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                words, hashes = _lowered(part)
                starts = words.gram_starts(GRAM)
                grams = gram_hashes(hashes, GRAM)[starts]
                hit = hits(grams, bits.value)
                at, grams = starts[hit], grams[hit]
                row = words.row[at]
                new = np.ones(len(at), bool)
                new[1:] = (row[1:] != row[:-1]) | (at[1:] - at[:-1] > 2 * reach)
                chain = np.flatnonzero(new)
                piece = (at - np.repeat(at[chain], np.diff([*chain, len(at)]))) // (PIECE * reach)
                new[1:] |= piece[1:] != piece[:-1]
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(at))[: len(first)] - 1
                owner = row[first]
                begin = np.maximum(at[first] - reach, words.begin[owner])
                end = np.minimum(at[last] + reach, words.begin[owner + 1])
                short, chosen = _short(hashes), pa.array(owner + part.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(chosen),
                        batch.column(2).take(chosen),
                        pa.array(begin - words.begin[owner]),
                        pa.array([short[a:b] for a, b in zip(begin, end, strict=True)],
                                 pa.list_(pa.int32())),
                        pa.array([signed(np.unique(grams[a : b + 1]))
                                  for a, b in zip(first, last, strict=True)],
                                 pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "start", "words", "seeds"],
                )

    return docs.select("text", "doc_id", "text_hash").mapInArrow(run, PASSAGE)


def _padded(rows: list[np.ndarray], filler: int) -> np.ndarray:
    """Rows of words as one array; the filler is outside 32 bits and equals no word."""
    out = np.full((len(rows), max(map(len, rows))), filler, np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and the text word after its last one."""
    a, b = _padded(items, 1 << 40), _padded(texts, 1 << 41)
    place = np.arange(b.shape[1] + 1) * -GAP
    above = np.zeros((len(a), b.shape[1] + 1), np.int64)
    best, end = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    rows = np.arange(len(a))
    for i in range(a.shape[1]):
        same = b == a[:, i : i + 1]
        cell = np.zeros_like(above)
        cell[:, 1:] = above[:, :-1] + np.where(same, MATCH, MISMATCH)
        np.maximum(cell, above + GAP, out=cell)
        np.maximum(cell, 0, out=cell)
        cell = np.maximum.accumulate(cell + place, axis=1) - place
        top = cell.argmax(axis=1)
        better = cell[rows, top] > best
        best[better], end[better] = cell[rows, top][better], top[better]
        above = cell
    return best, end


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (doc_id, text_hash, start, words, item_key, item_words) the pairs that match."""
    for batch in batches:
        texts = [np.array(x) for x in batch.column(3).to_numpy(zero_copy_only=False)]
        items = [np.array(x) for x in batch.column(5).to_numpy(zero_copy_only=False)]
        score, end = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        order = np.argsort([len(x) for x in texts], kind="stable")[::-1]
        at = 0
        while at < len(order):
            some = order[at : at + max(1, CELLS // max(1, len(texts[order[at]])))]
            at += len(some)
            best, last = align([items[i] for i in some], [texts[i] for i in some])
            score[some] = best / (MATCH * np.array([len(items[i]) for i in some]))
            end[some] = last
        keep = pa.array(score >= THRESHOLD)
        columns = [
            batch.column(0),
            batch.column(1),
            batch.column(4),
            pa.array(score),
            pa.array(end + batch.column(2).to_numpy()),
        ]
        yield pa.RecordBatch.from_arrays(
            [c.filter(keep) for c in columns],
            names=["doc_id", "text_hash", "item_key", "score", "end_word"],
        )


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, score, end_word: the best alignment of each matching pair."""
    spark = docs.sparkSession
    docs = documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    items, items_path = write_shared(item_table(benchmark), "items")
    known, seeds_path = write_shared(seeds(docs, items), "seeds")
    longest = items.agg(F.max("n_words")).first()[0] or 0
    near, near_path = write_shared(
        passages(docs, known.select("gram"), 2 * longest + GRAM), "passages"
    )
    own = ["doc_id", "text_hash", "start"]
    pairs = (
        near.select(*own, F.explode("seeds").alias("gram"))
        .join(known, "gram")
        .select(*(F.col(c).alias(f"own_{c}") for c in own), "item_key")
        .distinct()
    )
    here = " AND ".join(f"{c} <=> own_{c}" for c in own)
    found, _ = write_shared(
        near.drop("seeds")
        .join(pairs, F.expr(here))
        .join(items.select("item_key", F.col("words").alias("item_words")), "item_key")
        .select(*own, "words", "item_key", "item_words")
        .mapInArrow(
            _scores,
            "doc_id bigint, text_hash bigint, item_key bigint, score double, end_word bigint",
        ),
        "matches",
    )
    drop_paths(spark, [seeds_path, near_path])
    best = F.max(F.struct("score", -F.col("end_word")))
    return (
        found.groupBy("doc_id", "text_hash", "item_key")
        .agg(best.alias("best"))
        .join(items.select("item_key", "item_id"), "item_key")
        .select(
            "doc_id", "text_hash", "item_id", "best.score", (-F.col("best.col2")).alias("end_word")
        )
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score and end_word of the documents that hold a benchmark item."""
    return matches(docs, benchmark).drop("text_hash")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns."""
    bad = matches(docs, benchmark).select(
        F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")
    )
    on = F.expr("CAST(doc_id AS bigint) <=> __bad_id AND xxhash64(text) = __bad_hash")
    return without(docs, bad.distinct(), on, "xxhash64(text)", "__bad_hash")
