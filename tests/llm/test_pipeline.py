from __future__ import annotations

import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import queries, suffix_dedup
from skyledger.llm.text import SLICE_BYTES
from tests.conftest import SMALL
from tests.llm import test_decontaminate, test_neardup
from tests.llm.test_bpe import expected, library  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_odd_rows(spark, stage):
    some = queries.table(spark, SMALL, "documents").limit(20)
    odd = spark.createDataFrame(
        [(None, "one two three", "en", "s", 13), (900, None, None, None, None), (901, "", "en", "s", 0)],
        some.schema,
    )
    out = stage(spark, some.union(odd), SMALL)
    assert out.columns == COLUMNS
    assert out.count() <= 23
    assert stage(spark, some.limit(0), SMALL).count() == 0


def test_list_of_stages():
    assert len(corpus_pipeline.STAGES) == 5 and public_tokenizers.path(queries.RANKS)


def marked_words(rows, window):
    """Per row, which characters lie in repeated windows of words, or between two that touch."""
    found = [list(re.finditer(r"[^\x20\x09-\x0D]+", t)) for _, t in rows]
    runs = lambda w: [tuple(x[0] for x in w[i : i + window]) for i in range(len(w) - window + 1)]
    seen = Counter(r for w in found for r in runs(w))
    out = []
    for (_, t), w in zip(rows, found, strict=True):
        gone = [False] * len(t)
        words = sorted({i + k for i, r in enumerate(runs(w)) if seen[r] > 1 for k in range(window)})
        for i in words:
            a, b = w[i].start(), w[i + 1].start() if i + 1 in words else w[i].end()
            gone[a:b] = [True] * (b - a)
        out.append(gone)
    return out


def gone_words(rows, window):
    """Texts without repeated windows of words."""
    both = zip(rows, marked_words(rows, window), strict=True)
    return sorted((d, "".join(c for c, g in zip(t, m, strict=True) if not g)) for (d, t), m in both)


def gone_both(rows):
    """Texts without repeated windows of 400 bytes or 51 words."""
    seen = Counter(b[p : p + 400] for b in (t.encode() for _, t in rows) for p in range(len(b) - 399))
    out = []
    for (d, t), marked in zip(rows, marked_words(rows, 51), strict=True):
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 399):
            if seen[b[p : p + 400]] > 1:
                gone[p : p + 400] = b"\1" * 400
        kept, at = "", 0
        for c, m in zip(t, marked, strict=True):
            size = len(c.encode())
            kept += c if not (m or any(gone[at : at + size])) else ""
            at += size
        out.append((d, kept))
    return out


def plain_stages(spark, folder, library):
    """(doc_id, n_tokens, digests) after all stages, by plain Python but for the classifier's verdicts."""
    judged = {r.doc_id: r.predicted for r in queries.op1_quality_trees(spark, folder).collect()}
    docs = queries.table(spark, folder, "documents").collect()
    rows = [(r.doc_id, r.text or "") for r in docs if judged[r.doc_id]]
    kept = {r[0] for r in test_neardup.brute(rows) if r[3]}
    rows = gone_both([r for r in rows if r[0] in kept])
    items = [(r.item_id, r.text) for r in queries.table(spark, folder, "benchmark").collect()]
    bad = {r[0] for r in test_decontaminate.brute(rows, items)}
    assert 0 < len(rows) < len(docs) and bad
    return sorted(((d, *expected(library, t)) for d, t in rows if d not in bad), key=str)


def test_stages_against_plain_python(spark, library):  # noqa: F811
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((tuple(r)[:4] for r in found), key=str) == plain_stages(spark, SMALL, library)
    assert all(len(r.ids) == r.n_tokens for r in found)


def test_odd_rows_through_all_stages(spark, library, tmp_path):  # noqa: F811
    """Nulls, empty texts, repeated rows and ids, a text longer than a slice, a clashing column."""
    rng = random.Random(9)
    docs = queries.table(spark, SMALL, "documents")
    good = [r.text for r in docs.where("length(text) > 700").orderBy("doc_id").limit(3).collect()]
    vocabulary = " ".join(good).split()
    long = " ".join(rng.choice(vocabulary) for _ in range(60_000))
    assert len(long.encode()) > SLICE_BYTES
    odd = [(None, good[0] + " and more", None, None, None), (90_001, None, "en", None, 4), (90_002, "", "en", "s", 0),
           (90_003, " \n\t", None, "s", 3), (90_004, long, "en", "s", None),
           (90_005, good[1] + " once", "en", "s", 1), (90_005, good[1] + " once", "en", "s", 1),
           (90_006, good[2], "en", "s", 1), (-5, good[2], "en", "s", 1)]
    whole = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("own", F.lit("clash"))
    whole.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        queries.table(spark, SMALL, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((tuple(r)[:4] for r in found), key=str) == plain_stages(spark, str(tmp_path), library)


def test_planted_passages_of_51_words_go(spark):
    """Passages of 51 words, all far below 400 bytes, in pairs and in a group; those of 50 stay."""
    rng = random.Random(7)
    own = lambda n: [f"{rng.randrange(10**6):x}" for _ in range(n)]
    long, tiny, short = own(51), [f"é{i}" for i in range(51)], own(50)
    texts = [" ".join(own(rng.randrange(90)) + p + own(rng.randrange(90)))
             for p in [long] * 2 + [tiny] * 5 + [short] * 2 + [long + own(30), long + own(30)] + [[]] * 3]
    texts[1] = texts[1].replace(" ", "\n\t")
    assert all(len(" ".join(p).encode()) < 400 for p in (long, tiny))
    rows = list(enumerate(texts)) + [(101, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.without_repeats(spark, docs, SMALL).collect()
    left = {r.doc_id: r.text for r in found}
    assert sorted(left.items()) == gone_words(rows, 51)
    for passage in (long, tiny):
        assert not any(" ".join(passage) in " ".join(t.split()) for t in left.values())
    assert sum(" ".join(short) in t for t in left.values()) == 2
    assert all(r.n_chars == len(r.text) for r in found)


@pytest.mark.parametrize("seed", range(2))
def test_windows_of_few_words(spark, seed):
    rng = random.Random(seed)
    pieces = [[rng.choice("abc") for _ in range(rng.choice([6, 12, 20]))] for _ in range(8)]
    rows = [(i, " ".join(sum((rng.choice([rng.choice(pieces), [rng.choice("abcdé")] * 2])
                              for _ in range(rng.randrange(7))), []))) for i in range(40)]
    docs = spark.createDataFrame(rows + [rows[5]], "doc_id long, text string")
    found = suffix_dedup.remove_repeats(docs, words=8).collect()
    assert sorted(map(tuple, found)) == gone_words(rows + [rows[5]], 8)
