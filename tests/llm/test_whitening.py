from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from skyledger.llm import queries, whitening
from tests.conftest import SMALL

COLUMNS = "vec_id long, embedding array<double>, label string, x string, n int"


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) and abs(c) < 2**34 for c in v)


def brute(rows, most=16):
    """(vec_id, component) -> (n, deviation, |whitened|, explained), by rational numbers."""
    rows = [(d, [math.floor(64 * c) + 1_000_000 for c in v]) for d, v in rows if usable(v)]
    found = []
    for dims in sorted({len(v) for _, v in rows} - {0}):
        fit = sorted({tuple(v) for _, v in rows if len(v) == dims})
        n = len(fit)
        sums = [sum(c) for c in zip(*fit)]
        far = [[n * c - s for c, s in zip(v, sums)] for v in fit]
        cov = np.array([[float(Fraction(sum(a[i] * a[j] for a in far), n**3)) for j in range(dims)]
                        for i in range(dims)])
        values, vectors = np.linalg.eigh(cov)
        for d, v in rows:
            if len(v) == dims:
                own = [n * c - s for c, s in zip(v, sums)]
                for k in range(min(most, dims)):
                    e, axis = values[-1 - k], vectors[:, -1 - k]
                    flat = e <= 1e-12 * max(values[-1], 1e-300)
                    white = None if flat else abs(float(np.dot(np.array(own) / n, axis))) / e**0.5
                    share = e / np.trace(cov) if np.trace(cov) else 0.0
                    found.append((d, k + 1, n, sum(c * c for c in own), white, share))
    return found


def agree(found, want):
    order = lambda r: (str(r[0]), r[1], r[3] or 0, r[4] is None or abs(r[4]))
    found, want = sorted(found, key=order), sorted(want, key=order)
    assert [tuple(r)[:3] for r in found] == [r[:3] for r in want]
    for a, b in zip(found, want, strict=True):
        assert a[3] == (b[3] if b[3] < 2**63 else None)
        assert (a[4] is None) == (b[4] is None)
        assert a[4] is None or abs(a[4]) == pytest.approx(b[4], rel=1e-6, abs=1e-8)
        assert a[5] == pytest.approx(b[5], rel=1e-6, abs=1e-12)


def test_query_against_whole_numbers(spark):
    found = queries.op11_whitening(spark, SMALL)
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, SMALL, "embeddings").collect()]
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                             "identity_error"]
    found = found.collect()
    agree(found, brute(rows))
    assert len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-9


def test_odd_vectors(spark):
    rng = random.Random(3)
    own = lambda: [rng.gauss(0.3, 2) for _ in range(3)]
    one = own()
    rows = [(i, own()) for i in range(30)] + [(7, one), (7, one), (None, one), (50, [c + 1e-9 for c in one])]
    rows += [(60, None), (61, [1.0, None, 2.0]), (62, [1.0, math.nan, 0.0]), (63, [math.inf, 0.0, 0.0]),
             (64, []), (65, [1e300, 0.0, 0.0]), (66, [2.0, 3.0]), (67, [2.0, 5.0])]
    vectors = spark.createDataFrame([(*r, "a", "b", 9) for r in rows], COLUMNS)
    found = whitening.whiten(vectors).collect()
    agree(found, brute(rows))
    assert max(r.identity_error for r in found) < 1e-9
    assert not {60, 61, 62, 63, 64, 65} & {r.vec_id for r in found}
    assert whitening.whiten(vectors.limit(0)).count() == 0


def test_vectors_that_do_not_vary(spark):
    rows = [(i, [1.5, -2.0, float(i % 2)]) for i in range(6)] + [(9, [4.0])] * 3
    vectors = spark.createDataFrame([(*r, "a", "b", 9) for r in rows], COLUMNS)
    found = whitening.whiten(vectors).collect()
    agree(found, brute(rows))
    assert {(r.component, r.whitened is None) for r in found if r.vec_id < 9} == {(1, False), (2, True), (3, True)}


def test_far_entries_stay_exact(spark):
    """Centred numbers past 24 bits, whose squares go through Python's whole numbers."""
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.randrange(10) for _ in range(4)]) for i in range(200)]
    vectors = spark.createDataFrame([(*r, "a", "b", 9) for r in rows], COLUMNS)
    agree(whitening.whiten(vectors.repartition(7)).collect(), brute(rows))


def test_few_components_and_float_entries(spark):
    rows = [(i, [0.1 * i, 0.1 * i * i % 7, -0.3]) for i in range(40)]
    vectors = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    found = whitening.whiten(vectors, components=1).collect()
    single = [(str(d), np.array(v, np.float32).astype(float).tolist()) for d, v in rows]
    agree(found, brute(single, most=1))
