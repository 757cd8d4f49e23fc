from __future__ import annotations

import hashlib
import random
import re

import pytest

from skyledger.llm import doubling_dedup, queries
from skyledger.llm.oracle import ORACLE_SQL
from skyledger.llm.text import SLICE_BYTES
from tests.conftest import SMALL
from tests.llm.test_neardup import colliding
from tests.oracle_check import connect, difference

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    docs = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, keeps = set(), {}
    for row in docs:
        words = WORD.findall(row[1] or "")
        keep = [True] * len(words)
        for p in range(len(words) - window + 1):
            run = tuple(words[p : p + window])
            if run in seen:
                keep[p : p + window] = [False] * window
            seen.add(run)
        kept = " ".join(w for w, k in zip(words, keep, strict=True) if k)
        keeps[row] = (row[0], len(words), keep.count(False), hashlib.sha256(kept.encode()).hexdigest())
    return sorted((keeps[r] for r in rows), key=str)


def run(spark, rows, **sizes):
    docs = spark.createDataFrame(
        [(*r, 1, "k") for r in rows], "doc_id long, text string, at int, half string"
    )
    found = doubling_dedup.word_digests(docs, **sizes).collect()
    return sorted((tuple(r) for r in found), key=str)


def test_query_matches_oracle(spark):
    found = queries.op5_doubling_dedup(spark, SMALL)
    assert difference(found, connect(SMALL), ORACLE_SQL["op5_doubling_dedup"]) is None


@pytest.mark.parametrize("seed", range(3))
def test_few_words(spark, seed):
    rng = random.Random(seed)
    known = ["a", "b"] if seed == 0 else [f"w{i}" for i in range(6 * seed**3)]
    pieces = [rng.choices(known, k=rng.choice([15, 22, 45])) for _ in range(6)]
    rows = []
    for i in range(40):
        words = []
        for _ in range(rng.randrange(7)):
            words += rng.choice([rng.choice(pieces), rng.choices(known, k=7)])
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(words)))
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "x " * 19), (5, "y " * 20), (6, "z " * 21), (9, text),
            (8, text.replace(" ", "\n")), (8, text.replace(" ", "\n")), (10, "a " + text + " b " + text),
            (None, text), (12, text[:100]), (13, "é " * 40_000), (14, text.upper())]
    rows += [(100 + i, f"{i} {i} {text} {i}") for i in range(50)]
    assert run(spark, rows) == brute(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert doubling_dedup.word_digests(empty).count() == 0


def test_words_that_collide_as_polynomials(spark):
    a, b = colliding()
    rest = [f"w{i}" for i in range(25)]
    rows = [(1, " ".join([*rest, a])), (2, " ".join([*rest[:12], b, *rest[12:]])),
            (3, " ".join([*rest[:12], a, *rest[12:]])), (4, " ".join([b, *rest[6:], b])),
            (5, f"{a} {b} " * 30), (6, f"{b} {a} " * 9 + f"{a} " * 20)]
    assert run(spark, rows) == brute(rows)


def test_text_longer_than_a_slice(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:5000] + words[100:300])), (3, " ".join(words[59_000:]))]
    assert len(rows[0][1]) > SLICE_BYTES
    assert run(spark, rows) == brute(rows)
