"""Language identification: each document as a mixture of languages.

Learning counts hashed three-byte grams of the letters of all labelled training documents, in one
pass of map-side sums; a language is a smoothed multinomial over 2**12 buckets. For each document
expectation-maximisation estimates the proportions of all languages; then the first one, two, ...
languages by proportion are fitted by themselves, and the set grows as long as the penalised
likelihood rises (half the logarithm of the effective number of grams for each further language;
grams overlap, so three count as one), whatever its size. ``lang_pred`` is the language with the largest proportion of that
set, ``score`` the proportion; ``languages`` has the whole set.

The model has 2**12 numbers a language and goes to every task: at most ``MAX_LANGUAGES`` values of
``lang``, more than there are living languages, are learned (128 MB), and more are an error.

Defined cases: null text and texts without a letter of any script are ``und`` with score 0; of
equal proportions the first name wins; very long texts are counted whole, each in a slice of its own;
null or empty languages are not learned; a null id is held out; without any learned language
everything is ``und``; rows that repeat come out as often as they come in; columns other than
doc_id, text and lang are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.text import LOWER, Slice, slices
from skyledger.session import drop_paths, write_shared

BUCKETS = 1 << 12
SMOOTHING = 0.5
ROUNDS = 12
#: Grams that count as one, as they overlap.
OVERLAP = 3
#: The model is a row of 2**12 numbers for each language; more languages than this are an error.
MAX_LANGUAGES = 1 << 13
#: Languages whose counts come to the driver together.
FETCHED = 256
FOLDS, HELD_OUT = 4, 2
#: Documents of a slice that are fitted together.
TOGETHER = 256

_LETTERS = LOWER.copy()
_LETTERS[[i for i in range(128) if not chr(i).isalpha()]] = 32


def _grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every three bytes of a row, other bytes than letters as spaces."""
    data = _LETTERS[part.data].astype(np.uint32)
    if len(data) < 3:
        return (np.zeros(0, np.int64),) * 2
    value = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    row = np.repeat(np.arange(len(part)), np.diff(part.offsets))
    keep = (row[:-2] == row[2:]) & (value != 0x202020)
    bucket = (value * np.uint32(2654435761)) >> np.uint32(20)
    return row[:-2][keep], bucket[keep].astype(np.int64)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves the held-out remainder; a null id is held out."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == HELD_OUT, F.lit(True))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and the log probability of each bucket in each of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            for part in slices(batch.column(0)):
                row, bucket = _grams(part)
                own = names[part.first : part.first + len(part)]
                known = sorted(set(own))
                code = np.searchsorted(known, own)
                n = np.bincount(code[row] * BUCKETS + bucket, minlength=len(known) * BUCKETS)
                for name, counts in zip(known, n.reshape(-1, BUCKETS), strict=True):
                    sums[name] = sums.get(name, 0) + counts
        for name, counts in sums.items():
            full = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(full), pa.string()), pa.array(full), pa.array(counts[full])],
                names=["lang", "bucket", "n"],
            )

    train = docs.where("lang <> '' AND text IS NOT NULL").where(~held_out(F.col("doc_id")))
    counts = (
        train.select("text", "lang")
        .mapInArrow(count, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    counts, path = write_shared(counts, "gram-counts")
    languages = [r.lang for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang")
    languages.sort()
    log_likely = np.zeros((len(languages), BUCKETS), np.float32)
    for at in range(0, len(languages), FETCHED):
        names = np.array(languages[at : at + FETCHED], dtype=object)
        table = counts.where(F.col("lang").between(names[0], names[-1])).toArrow()
        seen = np.full((len(names), BUCKETS), SMOOTHING)
        code = np.searchsorted(names, table["lang"].to_numpy())
        seen[code, table["bucket"].to_numpy()] += table["n"].to_numpy()
        log_likely[at : at + FETCHED] = np.log(seen / seen.sum(axis=1, keepdims=True))
    drop_paths(docs.sparkSession, [path])
    return languages, log_likely


def _maximise(counts: np.ndarray, likely: np.ndarray, shares: np.ndarray) -> tuple:
    """EM from ``shares`` (a share of zero stays zero); the shares and log likelihoods."""
    total = counts.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        expected = counts / np.maximum(shares @ likely, 1e-30)
        shares = shares * (expected @ likely.T) / np.maximum(total, 1)
        shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1e-30)
    return shares, (counts * np.log(np.maximum(shares @ likely, 1e-30))).sum(axis=1)


def mixture(counts: np.ndarray, log_likely: np.ndarray) -> np.ndarray:
    """Proportion of each language in each row of bucket counts; languages left out have 0."""
    log_likely = log_likely.astype(float)
    likely = np.exp(log_likely)
    n = len(likely)
    if not n:
        return np.zeros((len(counts), 0))
    shares, _ = _maximise(counts, likely, np.full((len(counts), n), 1 / n))
    order = np.argsort(-shares, axis=1, kind="stable")
    rows = np.arange(len(counts))
    best = np.zeros_like(shares)
    best[rows, order[:, 0]] = 1
    top = (counts @ log_likely.T)[rows, order[:, 0]] / OVERLAP
    penalty = 0.5 * np.log(np.maximum(counts.sum(axis=1) / OVERLAP, 1))
    growing = rows
    for size in range(2, n + 1):
        growing = growing[shares[growing, order[growing, size - 1]] > 0]
        if not len(growing):
            break
        chosen = np.zeros((len(growing), n))
        chosen[np.arange(len(growing))[:, None], order[growing, :size]] = 1 / size
        found, fit = _maximise(counts[growing], likely, chosen)
        fit = fit / OVERLAP - penalty[growing] * (size - 1)
        better = fit > top[growing]
        growing = growing[better]
        best[growing], top[growing] = found[better], fit[better]
    return best


def _has_letter(part: Slice) -> np.ndarray:
    found = np.zeros(len(part), bool)
    plain = (_LETTERS[part.data] != 32) & (part.data < 128)
    before = np.concatenate([[0], np.cumsum(plain)])
    found[before[part.offsets[1:]] > before[part.offsets[:-1]]] = True
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in part.bytes_of(i).decode())
    return found


def predict(docs: DataFrame, languages: list[str], log_likely: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score and languages (name and proportion) for each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(log_likely)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, sets = [], [], []
            for part in slices(batch.column(1)):
                row, bucket = _grams(part)
                letter = _has_letter(part)
                edge = np.searchsorted(row, np.arange(0, len(part) + TOGETHER, TOGETHER))
                for k, at in enumerate(range(0, len(part), TOGETHER)):
                    n = min(TOGETHER, len(part) - at)
                    a, b = edge[k], edge[k + 1]
                    cells = (row[a:b] - at) * BUCKETS + bucket[a:b]
                    counts = np.bincount(cells, minlength=n * BUCKETS).reshape(n, BUCKETS)
                    used = np.flatnonzero(counts.any(axis=0))
                    shares = mixture(counts[:, used].astype(float), model.value[:, used])
                    for share, known in zip(shares, letter[at : at + n], strict=True):
                        known = known and bool(languages)
                        own = np.argsort(-share, kind="stable") if known else []
                        sets.append([(languages[j], share[j]) for j in own if share[j] > 0])
                        names.append(languages[own[0]] if known else "und")
                        scores.append(min(1.0, float(share[own[0]])) if known else 0.0)
            pairs = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            sets = [[{"lang": x, "share": y} for x, y in s] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(sets, pairs),
                ],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, lang_pred string, score double,"
        " languages array<struct<lang: string, share: double>>",
    )


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score for each row of ``docs`` (doc_id, text, lang)."""
    languages, log_likely = learn(docs)
    return predict(docs, languages, log_likely).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
