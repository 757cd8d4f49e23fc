from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from skyledger.llm import queries, suffix_dedup
from skyledger.llm.oracle import ORACLE_SQL
from tests.conftest import SMALL
from tests.oracle_check import connect, difference


def brute(rows, window=400):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[p : p + window] for _, b in data for p in range(len(b) - window + 1))
    found = []
    for d, b in data:
        keep = bytearray(b"\1" * len(b))
        for p in range(len(b) - window + 1):
            if seen[b[p : p + window]] > 1:
                keep[p : p + window] = bytes(window)
        flags = "".join("K" if k else "." for k in keep)
        spans = sum(1 for x in flags.split("K") if x)
        kept = bytes(x for x, k in zip(b, keep, strict=True) if k)
        found.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def run(spark, rows, **sizes):
    docs = spark.createDataFrame(
        [(*r, 1, "k") for r in rows], "doc_id long, text string, at int, key string"
    )
    found = suffix_dedup.span_digests(docs, **sizes).collect()
    return sorted((tuple(r) for r in found), key=str)


def test_whole_table(spark):
    docs = queries.table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted((tuple(r) for r in queries.op2_suffix_dedup(spark, SMALL).collect()), key=str)
    assert found == brute(rows)


def test_query_matches_oracle(spark):
    found = queries.op2_suffix_dedup(spark, SMALL)
    assert difference(found, connect(SMALL), ORACLE_SQL["op2_suffix_dedup"]) is None


@pytest.mark.parametrize("seed", range(3))
def test_short_windows_of_few_letters(spark, seed):
    rng = random.Random(seed)
    letters = ["ab", "abcdefgh", "aé🙂"][seed]
    pieces = ["".join(rng.choices(letters, k=rng.choice([15, 40, 70]))) for _ in range(8)]
    rows = [
        (i, "".join(rng.choice([rng.choice(pieces), "".join(rng.choices(letters, k=25))])
                    for _ in range(rng.randrange(9))))
        for i in range(40)
    ]
    assert run(spark, rows, window=40, anchor=10) == brute(rows, 40)


def test_odd_rows(spark):
    rng = random.Random(9)
    text = "".join(rng.choices("abcdef ", k=900))
    passage = "".join(rng.choices("ghij é", k=500))
    rows = [(1, None), (2, ""), (3, "x" * 399), (4, "y" * 400), (5, "z" * 401), (6, text), (7, text),
            (8, "p" + text[100:600] + "q"), (9, text + "!" + text), (None, text), (10, text[:399]),
            (11, "u" * 30_000), (11, "other text under one id " * 3), (12, "own" + text[:400]),
            (13, "own" + text[:400])]
    rows += [(100 + i, f"{i}" * rng.randrange(9) + passage + f"{i}" * rng.randrange(9)) for i in range(60)]
    assert run(spark, rows) == brute(rows)
    assert suffix_dedup.span_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_removal_keeps_whole_characters_and_columns(spark):
    rows = [(1, "éa" * 30 + "b" * 41, 7), (2, "x" + "b" * 41, 8), (3, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans long")
    found = suffix_dedup.remove_repeats(docs, window=40, anchor=10).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == [(1, "", 7), (2, "x", 8), (3, None, 9)]
