from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators import trees
from skyledger.operators.trees import Flat, Growth
from skyledger.plans import delay_model

FEATURES = ["a", "b", "c"]


def made(spark, n=600, seed=1):
    """The label leans on a and, for high b, on c; some values and keys repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(200) / 10, float(rng.randrange(5)), rng.choice([-1.0, 0.5, 2.0])
        p = 0.15 + 0.5 * (a > 12) + 0.3 * (b > 2) * (c > 0)
        rows.append((a, b, c, float(rng.random() < p), f"{i % (n - 20):032x}"))
    return spark.createDataFrame(rows, "a double, b double, c double, label double, key string")


def nodes(forest):
    return sorted(zip(forest.tree, forest.node, forest.n, forest.split), key=lambda r: r[:2])


def test_first_split_is_the_best_of_all(spark):
    rows = made(spark)
    growth = Growth(trees=1, depth=1, min_leaf=20, tried=3, bins=16)
    forest = trees.grow(rows, FEATURES, growth)
    flat, data = forest.flat(), rows.collect()
    draws = trees._draws([r.key for r in data], growth)[:, 0]
    bins = flat.bins([np.array([r[f] for r in data]) for f in FEATURES])
    weight = np.array([forest.weights[int(r.label)] for r in data]) * draws
    label = np.array([r.label for r in data])

    def impurity(mask):
        w = weight[mask].sum()
        share = (weight[mask] * label[mask]).sum() / w
        return w * 2 * share * (1 - share)

    best = (-1, None)
    for f, cut in itertools.product(range(3), range(15)):
        left = bins[:, f] <= cut
        if min(draws[left].sum(), draws[~left].sum()) >= 20:
            every = np.ones(len(data), bool)
            fall = (impurity(every) - impurity(left) - impurity(~left)) / weight.sum()
            best = max(best, (round(fall, 10), (-f, -cut)))
    feature, cut, gain = forest.split[0]
    assert (round(gain, 10), (-feature, -cut)) == (best[0], best[1])
    assert forest.n[0] == tuple(sum(forest.n[i][k] for i in (1, 2)) for k in (0, 1))


def test_trees_do_not_depend_on_partitions(spark):
    rows, growth = made(spark), Growth(trees=5, depth=4, min_leaf=10, tried=2, bins=8)
    one = trees.grow(rows.coalesce(1), FEATURES, growth)
    many = trees.grow(rows.orderBy("c").repartition(7), FEATURES, growth)
    assert nodes(one) == nodes(many) and len(one.node) > 25
    assert all(sum(n) >= 10 for n in one.n)
    other = trees.grow(rows, FEATURES, Growth(trees=5, depth=4, min_leaf=10, tried=2, bins=8, seed=7))
    assert nodes(other) != nodes(one)


def test_ends_of_bins(spark):
    rows = spark.createDataFrame([(float(i % 3), float(i)) for i in range(1000)], "few double, many double")
    few, many = trees.quantile_ends(rows, ["few", "many"], 4)
    assert few.tolist() == [0, 1] and many.tolist() == [249, 499, 749]


def test_odd_training_rows(spark):
    none = made(spark).limit(0)
    forest = trees.grow(none, FEATURES, Growth(trees=2, depth=3))
    assert nodes(forest) == [(0, 1, (0, 0), None), (1, 1, (0, 0), None)]
    single = made(spark).where("label = 1")
    forest = trees.grow(single, FEATURES, Growth(trees=2, depth=3, min_leaf=5))
    scored = single.select(trees.scores(forest).alias("p")).distinct().collect()
    assert [r.p for r in scored] == [1.0] and len(forest.node) == 2


def enumerated(flat: Flat, row) -> list[float]:
    """Shapley values by all subsets of features, walking both ways where one is not known."""

    def value(node, known):
        if flat.left[node] < 0:
            return flat.value[node] / (trees.UNIT * flat.trees)
        f, left = flat.feature[node], flat.left[node]
        if f in known:
            return value(left + int(row[f] > flat.cut[node]), known)
        return sum(value(c, known) * flat.weight[c] for c in (left, left + 1)) / flat.weight[node]

    score = lambda known: sum(value(t, known) for t in range(flat.trees))
    m, found = len(flat.ends), []
    for j in range(m):
        others = [i for i in range(m) if i != j]
        total = 0.0
        for k in range(m):
            for s in itertools.combinations(others, k):
                weight = math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m)
                total += weight * (score({*s, j}) - score(set(s)))
        found.append(total)
    return found


def test_attributions_against_subsets(spark):
    rows = made(spark)
    forest = trees.grow(rows, FEATURES, Growth(trees=4, depth=5, min_leaf=8, tried=2, bins=16))
    some = rows.limit(40).select(
        *FEATURES, trees.scores(forest).alias("score"), trees.row_attributions(rows, forest).alias("parts")
    ).collect()
    flat = forest.flat()
    bins = flat.bins([np.array([r[f] for r in some]) for f in FEATURES])
    for r, row in zip(some, bins, strict=True):
        assert r.parts == pytest.approx(enumerated(flat, row), abs=1e-9)
        assert flat.base() + sum(r.parts) == pytest.approx(r.score, abs=1e-9)
    means = {r.feature: r for r in trees.mean_attributions(rows.limit(40), forest).collect()}
    for i, f in enumerate(FEATURES):
        assert means[f].mean_size == pytest.approx(np.mean([abs(r.parts[i]) for r in some]), abs=1e-9)
        assert means[f]["mean"] == pytest.approx(np.mean([r.parts[i] for r in some]), abs=1e-9)


def test_importances_of_a_node_table(spark):
    forest = trees.grow(made(spark), FEATURES, Growth(trees=6, depth=3, min_leaf=20, tried=2))
    found = trees.importances(forest.table(spark), FEATURES, forest.weights).collect()
    assert sum(r.importance for r in found) == pytest.approx(1)
    assert max(found, key=lambda r: r.importance).feature == "a"


def test_rows_with_the_next_key(spark):
    names = list(delay_model.FEATURES)
    keys = ["000a", "000b", "00a1", "fff1", "fff0", "0c0d"]
    rows = spark.createDataFrame(
        [(k, *[float(i)] * len(names)) for i, k in enumerate(keys)],
        "key string, " + ", ".join(f"{n} double" for n in names),
    )
    found = {r.key: r.next[0] for r in delay_model.with_next(rows.repartition(3)).collect()}
    order = sorted(keys)
    assert found == {k: float(keys.index(order[(i + 1) % 6])) for i, k in enumerate(order)}
    [alone] = delay_model.with_next(rows.limit(1)).select(F.col("next")[names[0]].alias("x")).collect()
    assert alone.x == 0.0
