"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents.

Statistics are vectorised over Arrow batches in numpy. The trees are fitted on a bounded sample of
labelled documents (``SAMPLE`` at most, the lowest hashes of the id), on quantile bins of each
statistic, and flattened into arrays (feature, threshold, value by node) that tasks traverse for
all documents and trees of a slice at once. Nothing but the sample's statistics and the flat trees
passes through the driver.

Defined cases: null and empty texts have statistics of zero and a score; ids, language, source
and labels are no inputs of a score; a null id is never learned from and counts as held out if
null; with no labelled rows every score is 0.5; with one class only, that class's share. Rows
that repeat come out as often as they come in; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from skyledger.llm.text import Slice, SpanHash, Words, gram_hashes, slices

#: Labelled documents that the trees are fitted on, at most.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 60, 4, 0.15, 64
MIN_WEIGHT, RIDGE = 2.0, 1.0
THRESHOLD = 0.3
#: One in so many documents, by crc32 of the id, is held out.
FOLDS = 5

SYMBOLS = "#*$%&|<>"
STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "longest_word", "words_a_line",
    "upper", "digits", "symbols", "stops", "other_marks", "spaces", "not_ascii", "bang",
    "entropy", "distinct_words", "top_word", "repeated_pairs", "repeated_fives",
    "repeated_lines", "same_as_last", "letters_only", "capital_words",
)


def _classes() -> np.ndarray:
    """Bytes by class, as columns: upper, digit, symbol, stop, other mark, space, non-ASCII, !."""
    found = np.zeros((256, 8))
    for i in range(256):
        c = chr(i)
        if i >= 128:
            found[i, 6] = 1
        elif c.isupper():
            found[i, 0] = 1
        elif c.isdigit():
            found[i, 1] = 1
        elif c in SYMBOLS:
            found[i, 2] = 1
        elif c in ".,;:":
            found[i, 3] = 1
        elif c.isspace():
            found[i, 5] = 1
        elif not c.isalpha():
            found[i, 4] = 1
    found[ord("!"), 7] = 1
    return found


_CLASSES = _classes()


def _repeats(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the commonest one, by row (by 44 bits of the values)."""
    packed = np.sort((row.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(packed)), bool),
                                           packed[1:] != packed[:-1]]))
    owner = (packed[first] >> np.uint64(44)).astype(np.int64)
    distinct = np.bincount(owner, minlength=n)
    return distinct, _highest(np.diff(np.append(first, len(packed))), distinct)


def _highest(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Largest of the values of each row, which lie row by row; 0 where a row has none."""
    top = np.zeros(len(counts))
    full = np.flatnonzero(counts)
    if len(full):
        top[full] = np.maximum.reduceat(values, (np.cumsum(counts) - counts)[full])
    return top


def statistics(part: Slice) -> np.ndarray:
    """One row of ``STATISTICS`` for each text of a slice."""
    n, data = len(part), part.data
    sizes = np.diff(part.offsets)
    words = Words(part)
    counts = np.maximum(words.counts, 1)
    byte_row = np.repeat(np.arange(n), sizes)
    found = np.zeros((n, len(STATISTICS)))
    shares, entropy = np.zeros((n, 8)), np.zeros(n)
    for at in range(0, n, 1024):
        to = min(n, at + 1024)
        a, b = part.offsets[at], part.offsets[to]
        cells = (byte_row[a:b] - at) * 256 + data[a:b]
        hist = np.bincount(cells, minlength=256 * (to - at)).reshape(-1, 256)
        share = hist / np.maximum(sizes[at:to, None], 1)
        shares[at:to] = share @ _CLASSES
        entropy[at:to] = -(share * np.log2(np.maximum(share, 1e-12))).sum(axis=1)
    lengths = words.end - words.start
    per_word = lambda x: np.bincount(words.row, x, minlength=n) / counts
    longest = _highest(lengths, words.counts)
    spans = SpanHash(data)
    hashes = spans(words.start, words.end)
    distinct, top = _repeats(words.row, hashes, n)
    pair_at, five_at = words.gram_starts(2), words.gram_starts(5)
    pairs, _ = _repeats(words.row[pair_at], gram_hashes(hashes, 2)[pair_at], n)
    fives, _ = _repeats(words.row[five_at], gram_hashes(hashes, 5)[five_at], n)
    n_pairs, n_fives = np.maximum(words.counts - 1, 0), np.maximum(words.counts - 4, 0)
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([part.offsets[:-1][sizes > 0], breaks + 1]))
    starts = starts[starts < len(data)].astype(np.int64)
    line_row = byte_row[starts]
    ends = np.append(starts[1:], len(data))[: len(starts)]
    n_lines = np.bincount(line_row, minlength=n)
    lines, _ = _repeats(line_row, spans(starts, ends - (data[ends - 1] == 10)), n)
    again = hashes[1:] == hashes[:-1]
    again &= words.row[1:] == words.row[:-1]
    letter = _CLASSES[:, [1, 2, 3, 4]].sum(axis=1) == 0
    odd = np.concatenate([[0], np.cumsum(~letter[data])])
    columns = [
        np.log1p(sizes), np.log1p(words.counts), np.log1p(n_lines), per_word(lengths), longest,
        words.counts / np.maximum(n_lines, 1), *shares.T, entropy, distinct / counts,
        top / counts, 1 - pairs / np.maximum(n_pairs, 1), 1 - fives / np.maximum(n_fives, 1),
        1 - lines / np.maximum(n_lines, 1), np.bincount(words.row[1:][again], minlength=n) / counts,
        per_word(odd[words.end] == odd[words.start]), per_word(_CLASSES[data[words.start], 0]),
    ]
    for i, column in enumerate(columns):
        found[:, i] = column
    found[sizes == 0] = 0
    return found.astype(np.float32)


@dataclass
class Trees:
    """Boosted trees as arrays: node ``i`` of a tree has the children ``2i+1`` and ``2i+2``.

    ``feature`` and ``threshold`` are (trees, inner nodes), ``value`` is (trees, leaves).
    """

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        trees, inner = self.feature.shape
        total = np.full(len(x), self.base)
        if inner:
            each = np.arange(trees)
            for at in range(0, len(x), 4096):
                rows = x[at : at + 4096]
                place = np.arange(len(rows))[:, None]
                node = np.zeros((len(rows), trees), np.int64)
                while node[0, 0] < inner:
                    right = rows[place, self.feature[each, node]] > self.threshold[each, node]
                    node = 2 * node + 1 + right
                total[at : at + 4096] += self.value[each, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost ``TREES`` trees of ``DEPTH`` levels for labels 0 and 1."""
    share = y.mean() if len(y) else 0.5
    base = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1)))
    if share in (0, 1) or not len(y):
        return Trees(base, *(np.zeros((0, 0)),) * 3)
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature = np.zeros((TREES, inner), np.int64)
    threshold = np.full((TREES, inner), np.inf, np.float32)
    value = np.zeros((TREES, leaves))
    raw = np.full(n, base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            start, count = 2**level - 1, 2**level
            local = node - start
            best = np.full(count, 1e-9)
            split_bin = np.full(count, BINS)
            for j in range(width):
                cell = local * BINS + bins[j]
                g = np.bincount(cell, gradient, count * BINS).reshape(count, BINS).cumsum(axis=1)
                h = np.bincount(cell, weight, count * BINS).reshape(count, BINS).cumsum(axis=1)
                gr, hr = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + RIDGE) + gr**2 / (hr + RIDGE)
                gain -= g[:, -1:] ** 2 / (h[:, -1:] + RIDGE)
                gain[(h < MIN_WEIGHT) | (hr < MIN_WEIGHT)] = 0
                at = gain[:, : len(cuts[j])].argmax(axis=1) if len(cuts[j]) else np.zeros(count, int)
                top = gain[np.arange(count), at]
                better = top > best
                best[better], split_bin[better] = top[better], at[better]
                feature[t, start : start + count][better] = j
                if better.any():
                    threshold[t, start : start + count][better] = cuts[j][at[better]]
            chosen = feature[t, node]
            node = 2 * node + 1 + (bins[chosen, np.arange(n)] > split_bin[local])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, weight, leaves)
        value[t] = RATE * g / (h + RIDGE)
        raw += value[t, leaf]
    return Trees(base, feature, threshold, value)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id is held out."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit the trees on at most ``sample`` labelled documents that are not held out."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("label_id"), "label_id", "quality")
        .limit(sample)
    )
    rows = docs.join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                found = [pa.array(c) for c in statistics(part).T]
                quality = batch.column(1).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays([quality, *found], names=["quality", *STATISTICS])

    schema = "quality int, " + ", ".join(f"{s} float" for s in STATISTICS)
    table = rows.select("text", "quality").mapInArrow(measure, schema).toArrow()
    x = np.column_stack([table[s].to_numpy() for s in STATISTICS])
    y = table["quality"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order])


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with a column ``score`` for the whole of ``text``; one of that name is replaced.

    Only texts go to Python and only scores come back.
    """

    @F.arrow_udf(DoubleType())
    def of_texts(texts: pa.Array) -> pa.Array:
        found = [trees.score(statistics(part)) for part in slices(texts)]
        return pa.array(np.concatenate([np.zeros(0), *found]))

    return docs.withColumn("score", of_texts(F.col("text")))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``."""
    rows = docs.select("doc_id", "text")
    return score(rows, train(rows, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    trees = train(docs.select("doc_id", "text"), labels)
    wrapped = docs.select(F.struct(*docs.columns).alias("own"), F.col("text"))
    kept = score(wrapped, trees).where(F.col("score") >= THRESHOLD)
    return kept.select(*[F.col(f"own.`{c}`") for c in docs.columns])
