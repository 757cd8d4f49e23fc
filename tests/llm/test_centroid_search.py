from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from skyledger.llm import centroid_search, queries
from skyledger.llm.oracle import ORACLE_SQL
from tests.conftest import SMALL
from tests.oracle_check import connect, difference

COLUMNS = "vec_id long, embedding array<double>, cluster string, v int"


def plain(rows, clusters=8, rounds=10):
    """Every distance spelled out, in Python's whole numbers."""
    rows = [(d, [math.floor(1024 * c) for c in v]) for d, v in rows
            if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    sha = lambda d: hashlib.sha256(f"3:{d}".encode()).hexdigest()
    points = [v for d, v in sorted(rows, key=lambda r: (r[0] is None, sha(r[0]), r[1]))[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in rows]
        for c in range(len(points)):
            members = [v for (_, v), o in zip(rows, own) if o == c]
            if members:
                points[c] = [sum(x) // len(members) for x in zip(*members)]
    last = [nearest(v) for _, v in rows]
    inertia = {c: sum(d for d, o in last if o == c) for _, c in last}
    text = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), text[c])
                   for (i, _), (d, c) in zip(rows, last)), key=str)


def found(spark, rows, **more):
    vectors = spark.createDataFrame([(*r, "a", 1) for r in rows], COLUMNS)
    return sorted(map(tuple, centroid_search.cluster(vectors, **more).collect()), key=str)


def test_query_matches_oracle(spark):
    query = queries.op12_centroid_clusters(spark, SMALL)
    assert difference(query, connect(SMALL), ORACLE_SQL["op12_centroid_clusters"]) is None


def test_odd_vectors(spark):
    rng = random.Random(1)
    own = lambda: [rng.gauss(0, 0.2) for _ in range(64)]
    one = own()
    rows = [(i, own()) for i in range(60)] + [(5, one)] * 40 + [(None, one), (None, own())]
    rows += [(70, None), (71, one[:63]), (72, [*one[:63], None]), (73, [*one[:63], math.nan]),
             (74, [*one[:63], -math.inf]), (75, [])]
    rng.shuffle(rows)
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[:0] + [(70, None)]) == []


def test_fewer_vectors_than_centroids_and_ties(spark):
    """Points on a small grid: many equal distances, empty clusters, equal start vectors."""
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.001, -0.002])] * 63 + [rng.choice([0.0, 1.0])]) for i in range(80)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[:3]) == plain(rows[:3])
    assert found(spark, rows, clusters=20, rounds=3) == plain(rows, 20, 3)


@pytest.mark.parametrize("spread", [1, 40, 1 << 25])
def test_search_equals_all_distances_and_computes_fewer(spread):
    rng = np.random.default_rng(spread)
    points = rng.integers(-spread, spread + 1, (40, 64)) + rng.integers(-spread, spread + 1, (40, 1)) * 4
    x = points[rng.integers(0, 40, 3000)] + rng.integers(-spread, spread + 1, (3000, 64)) // 8
    label, distance, computed = centroid_search.Centroids(points).nearest(x)
    every = ((x[:, None] - points[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (label == every.argmin(axis=1)).all()
    assert computed < 0.5 * every.size
