from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import language_mixture as lm
from skyledger.llm import queries
from skyledger.llm.text import slices
from tests.conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in queries.table(spark, MEDIUM, "documents").collect()}
    rows = queries.op7_language_mixture(spark, MEDIUM).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 200
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97


def test_grams_by_hand():
    [part] = slices(pa.array(["abC", "é", None, "--- ?", "ab"]))
    row, bucket = lm._grams(part)
    code = lambda s: (int.from_bytes(s, "big") * 2654435761 % 2**32) >> 20
    assert list(zip(row, bucket, strict=True)) == [(0, code(b"abc"))]


def test_two_languages_in_one_text():
    rng = np.random.default_rng(3)
    log_likely = np.log(rng.dirichlet(np.full(300, 0.2), 3) + 1e-6)
    likely = np.exp(log_likely)
    likely /= likely.sum(axis=1, keepdims=True)
    counts = np.stack([
        rng.multinomial(900, likely[1]),
        rng.multinomial(900, 0.7 * likely[2] + 0.3 * likely[0]),
        np.zeros(300, int),
    ]).astype(float)
    shares = lm.mixture(counts, log_likely)
    assert list(shares[0]) == [0, 1, 0]
    assert shares[1, 1] == 0 and shares[1, 2] == pytest.approx(0.7, abs=0.06)
    assert shares[2].sum() == 1


def test_six_languages_in_one_text():
    rng = np.random.default_rng(5)
    log_likely = np.log(rng.dirichlet(np.full(400, 0.1), 8) + 1e-6)
    likely = np.exp(log_likely)
    likely /= likely.sum(axis=1, keepdims=True)
    truth = np.array([0.3, 0, 0.2, 0.15, 0, 0.15, 0.1, 0.1])
    counts = np.stack([rng.multinomial(4000, truth @ likely), rng.multinomial(4000, likely[3])])
    shares = lm.mixture(counts.astype(float), log_likely)
    assert shares[0] == pytest.approx(truth, abs=0.05)
    assert [list(np.flatnonzero(s)) for s in shares] == [[0, 2, 3, 5, 6, 7], [3]]


def plain_counts(text):
    """Grams of a text by bucket, byte by byte."""
    low = [b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()]
    low = [b if b >= 128 or chr(b).isalpha() else 32 for b in low]
    found = {}
    for a, b, c in zip(low, low[1:], low[2:], strict=False):
        value = a << 16 | b << 8 | c
        if value != 0x202020:
            bucket = (value * 2654435761 % 2**32) >> 20
            found[bucket] = found.get(bucket, 0) + 1
    return found


def plain_fit(counts, likely, chosen):
    """Expectation-maximisation gram by gram from equal shares of the chosen languages."""
    shares = {lang: 1 / len(chosen) for lang in chosen}
    for _ in range(12):
        new = dict.fromkeys(chosen, 0.0)
        for bucket, n in counts.items():
            mixed = sum(shares[x] * likely[x][bucket] for x in chosen)
            for x in chosen:
                new[x] += n * shares[x] * likely[x][bucket] / mixed
        total = sum(new.values())
        shares = {x: v / total for x, v in new.items()}
    return shares, sum(
        n * math.log(sum(shares[x] * likely[x][b] for x in chosen)) for b, n in counts.items()
    )


def plain_set(counts, likely):
    """The set by penalised likelihood; languages are tried by falling share."""
    shares, _ = plain_fit(counts, likely, sorted(likely))
    order = sorted(likely, key=lambda x: (-shares[x], x))
    penalty = 0.5 * math.log(max(1, sum(counts.values()) / 3))
    best, top = None, -math.inf
    for size in range(1, len(order) + 1):
        found, fit = plain_fit(counts, likely, order[:size])
        if fit / 3 - penalty * (size - 1) <= top:
            break
        best, top = found, fit / 3 - penalty * (size - 1)
    return best


def test_whole_table_against_plain_python(spark):
    docs = queries.table(spark, SMALL, "documents").collect()
    seen = {}
    for r in docs:
        if r.lang and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            own = seen.setdefault(r.lang, {})
            for bucket, n in plain_counts(r.text).items():
                own[bucket] = own.get(bucket, 0) + n
    likely = {}
    for lang, own in seen.items():
        total = sum(own.values()) + 0.5 * 4096
        likely[lang] = [(own.get(b, 0) + 0.5) / total for b in range(4096)]
    found = {r.doc_id: r for r in queries.op7_language_mixture(spark, SMALL).collect()}
    assert len(found) == len(docs) and len(likely) == 4
    for r in docs:
        counts = plain_counts(r.text)
        if not any(c.isalpha() for c in r.text or ""):
            want = ("und", 0.0)
        else:
            assert counts
            shares = plain_set(counts, likely)
            lang = min(shares, key=lambda x: (-shares[x], x))
            want = (lang, shares[lang])
        assert found[r.doc_id].lang_pred == want[0]
        assert found[r.doc_id].score == pytest.approx(want[1], abs=1e-4)


def test_many_languages_and_long_texts(spark):
    letters = [a + b + c for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"]
    rows = [(i, f"{x} " * 30, f"l{x}") for i, x in enumerate(letters + letters)]
    rows += [(5000, letters[7] * 300_000, None), (5001, f"{letters[5]} {letters[6]} " * 200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    languages, log_likely = lm.learn(docs)
    assert len(languages) > 300
    found = {r.doc_id: r for r in lm.predict(docs, languages, log_likely).collect()}
    right = [found[i].lang_pred == lang for i, _, lang in rows[:-2] if lang in languages]
    assert np.mean(right) > 0.95 and found[5000].lang_pred == f"l{letters[7]}"
    assert {x.lang for x in found[5001].languages} == {f"l{letters[5]}", f"l{letters[6]}"}


def test_odd_rows(spark):
    rows = [(1, "the the the", "en"), (2, "der die das", "de"), (3, None, "de"), (4, "", "en"),
            (5, "123 !?", "en"), (6, "東", None), (None, "the", "en"), (7, "la", None),
            (8, "the " * 100_000, ""), (8, "the", "en"), (8, "the", "en"), (9, "a", "en")]
    docs = spark.createDataFrame(
        [(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double"
    )
    found = lm.identify(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].lang_pred for i in (3, 4, 5)} == {"und"}
    assert {by_id[i].lang_pred for i in (1, 8)} == {"en"} and by_id[2].lang_pred == "de"
    assert by_id[6].lang_pred in ("en", "de") and by_id[None].held_out
    assert {r.lang_pred for r in lm.identify(docs.withColumn("lang", docs.lang.substr(9, 1))).collect()} == {"und"}
    assert lm.identify(docs.limit(0)).count() == 0
