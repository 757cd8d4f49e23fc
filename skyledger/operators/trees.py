"""Decision trees for two classes, grown a level at a time from grouped counts.

Features become bins once, at quantiles of counts. A level is one aggregate over all rows: tasks
count the rows of each class by (tree, node, feature, bin), Spark sums these counts, running sums
over the bins give both sides of every split, and the split of highest gain wins. What moves is
bounded by nodes and bins; rows never move, each walks to its node by the splits so far. The driver
holds the node table, at most 2^(depth + 1) nodes a tree.

Counts and class weights are whole numbers and leaves hold whole billionths, so trees and scores
depend on neither partitions nor the order of rows, and SQL can repeat them. How often a tree draws a
row, and which features a node may split by, come from MD5.

``attributions`` are exact Shapley values of the score over the node counts: what is known of a
row goes down the tree by its values, what is not by the shares of the training weight.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.session import drop_paths, write_shared

#: Leaves hold the weighted share of class 1 in units of one over this.
UNIT = 1_000_000_000
#: Rows that a task counts at once.
CHUNK = 1 << 16
#: Counts that a task holds until its end; where a level has more, each chunk passes on its own.
HELD = 1 << 23
#: Rows that are explained at once; each leaf's patterns are worked out once for all of them.
EXPLAINED = 1 << 16
#: Gains are compared at this many digits.
DIGITS = 12
NODES = "tree int, node bigint, level int, n0 bigint, n1 bigint, feature int, bin int, gain double"


@dataclass(frozen=True)
class Growth:
    """How trees grow: their number and depth, least rows of a leaf, features tried at a node."""

    trees: int = 500
    depth: int = 18
    min_leaf: int = 50
    tried: int = 4
    bins: int = 64
    seed: int = 42


@dataclass
class Forest:
    """The nodes of all trees in one table, as arrays; children of heap node n are 2n and 2n + 1."""

    features: list[str]
    ends: list[np.ndarray]
    weights: tuple[int, int]
    trees: int
    tree: list[int] = field(default_factory=list)
    node: list[int] = field(default_factory=list)
    level: list[int] = field(default_factory=list)
    n: list[tuple[int, int]] = field(default_factory=list)
    split: list[tuple[int, int, float] | None] = field(default_factory=list)
    left: list[int] = field(default_factory=list)

    def add(self, tree: int, node: int, level: int, n0: int, n1: int) -> int:
        for own, value in ((self.tree, tree), (self.node, node), (self.level, level),
                           (self.n, (n0, n1)), (self.split, None), (self.left, -1)):
            own.append(value)
        return len(self.tree) - 1

    def table(self, spark: SparkSession) -> DataFrame:
        """tree, node, level, n0 and n1 (rows drawn of each class), feature, bin and gain (null in leaves).

        Rows whose bin of ``feature`` (its place) is at most ``bin`` go left.
        """
        none = (None, None, None)
        rows = [(t, i, k, *n, *(s or none))
                for t, i, k, n, s in zip(self.tree, self.node, self.level, self.n, self.split)]
        return spark.createDataFrame(rows, NODES)

    def flat(self) -> Flat:
        n = np.array(self.n, np.int64).reshape(-1, 2)
        w0, w1 = (n[:, k].astype(object) * self.weights[k] for k in (0, 1))
        value = [int(b) * UNIT // int(a + b) if a + b else 0 for a, b in zip(w0, w1)]
        split = [s or (-1, 0, 0.0) for s in self.split]
        return Flat(
            self.ends,
            np.array([s[0] for s in split], np.int32),
            np.array([s[1] for s in split], np.int32),
            np.array(self.left, np.int64),
            np.array(value, np.int64),
            (w0 + w1).astype(float),
            self.trees,
            max(self.level, default=0),
        )


@dataclass
class Flat:
    """Arrays by node that tasks walk; the roots are the first ``trees`` nodes.

    The right child stands after the left one. ``feature`` is -1 in leaves.
    """

    ends: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    trees: int
    levels: int

    def bins(self, columns: list[np.ndarray]) -> np.ndarray:
        found = [np.searchsorted(e, c, side="left") for e, c in zip(self.ends, columns, strict=True)]
        return np.stack(found, axis=1).astype(np.uint8)

    def walk(self, tree: int, bins: np.ndarray) -> np.ndarray:
        """The node that each row of ``bins`` comes to."""
        return self.descend(tree, *_flat_bins(bins))

    def descend(self, tree: int, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The node of each row, whose bins begin at ``starts`` in ``flat``. Leaves lead to themselves."""
        feature, cut, left, deep = self.steps[tree]
        at = np.zeros(len(starts), np.intp)
        for _ in range(deep):
            right = flat[starts + feature[at]] > cut[at]
            at = left[at] + right
        return self.own[tree][at]

    @cached_property
    def own(self) -> list[np.ndarray]:
        """The nodes of each tree from its root down."""
        found = []
        for tree in range(self.trees):
            nodes, level = [], np.array([tree])
            while len(level):
                nodes.append(level)
                inner = self.left[level]
                inner = inner[inner >= 0]
                level = np.stack([inner, inner + 1], axis=1).ravel()
            found.append(np.concatenate(nodes))
        return found

    @cached_property
    def steps(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """By tree: feature, cut and left child by place among the tree's own nodes, and its depth."""
        found = []
        for own in self.own:
            place = np.zeros(len(self.left), np.intp)
            place[own] = np.arange(len(own))
            inner = self.left[own] >= 0
            left = np.where(inner, place[self.left[own]], np.arange(len(own)))
            feature = np.where(inner, self.feature[own], 0).astype(np.intp)
            cut = np.where(inner, self.cut[own], 255).astype(np.uint8)
            deep, level = 0, np.array([0])
            while len(level := level[inner[level]]):
                level = np.concatenate([left[level], left[level] + 1])
                deep += 1
            found.append((feature, cut, left, deep))
        return found

    def score(self, bins: np.ndarray) -> np.ndarray:
        """Sum of the leaf values of all trees."""
        total, placed = np.zeros(len(bins), np.int64), _flat_bins(bins)
        for tree in range(self.trees):
            total += self.value[self.descend(tree, *placed)]
        return total

    def paths(self, tree: int) -> Iterator[tuple[int, dict[int, list]]]:
        """(leaf, {feature: [above, up to, share]}): the bins that lead there, and the weight's share."""
        todo: list[tuple[int, dict[int, list]]] = [(tree, {})]
        while todo:
            node, path = todo.pop()
            if self.left[node] < 0:
                yield node, path
                continue
            feature, cut = int(self.feature[node]), int(self.cut[node])
            for side in (0, 1):
                child = int(self.left[node]) + side
                above, upto, share = path.get(feature, [-1, 256, 1.0])
                bounds = [above, min(upto, cut)] if side == 0 else [max(above, cut), upto]
                share *= self.weight[child] / self.weight[node]
                todo.append((child, path | {feature: [*bounds, share]}))

    def base(self) -> float:
        """The mean score of the training weight."""
        total = 0.0
        for tree in range(self.trees):
            for leaf, path in self.paths(tree):
                total += self.value[leaf] * np.prod([share for *_, share in path.values()])
        return float(total) / (UNIT * self.trees)

    def attributions(self, bins: np.ndarray) -> np.ndarray:
        """Shapley values of each row's score by feature; with ``base`` they sum to the score.

        A leaf's part depends on which of its path's features lead a row there, so it is computed
        once for each such pattern that occurs.
        """
        found = np.zeros((len(self.ends), len(bins)))
        own, every = np.ascontiguousarray(bins.T, np.intp), np.arange(256)
        for tree in range(self.trees):
            for leaf, path in self.paths(tree):
                names = list(path)
                if not names or not self.value[leaf]:
                    continue
                code = np.zeros(len(bins), np.intp)
                for j, (name, (above, upto, _)) in enumerate(path.items()):
                    leads = (every > above) & (every <= upto)
                    code += np.take(leads.astype(np.intp) << j, own[name])
                share = np.array([share for *_, share in path.values()])
                if 1 << len(names) <= max(len(bins), 256):  # no more patterns than rows: no search
                    known, index = np.arange(1 << len(names)), code
                else:
                    known, index = np.unique(code, return_inverse=True)
                patterns = (known[:, None] >> np.arange(len(names)) & 1).astype(float)
                part = np.ascontiguousarray((_shapley(patterns, share) * self.value[leaf]).T)
                for name, values in zip(names, part, strict=True):
                    found[name] += np.take(values, index)
        return found.T / (UNIT * self.trees)


def _flat_bins(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bins in one row after the other, and where each row begins."""
    return np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]


def _shapley(leads: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley values of the product over players of ``leads`` (if known) or ``share`` (if not)."""
    rows, m = leads.shape
    weights = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    found = np.empty((rows, m))
    for j in range(m):
        by_size = np.zeros((rows, m))  # products summed over all sets of others, by their size
        by_size[:, 0] = 1.0
        for i in range(m):
            if i != j:
                known = by_size * leads[:, [i]]
                by_size = by_size * share[i]
                by_size[:, 1:] += known[:, :-1]
        found[:, j] = (leads[:, j] - share[j]) * (by_size @ weights)
    return found


def quantile_ends(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last: every value if there are few, else quantiles of counts.

    The driver gets fewer than ``bins`` numbers a feature.
    """
    each = [F.struct(F.lit(i).alias("feature"), F.col(f).cast("double").alias("value"))
            for i, f in enumerate(features)]
    counts = rows.select(F.inline(F.array(*each))).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    whole = Window.partitionBy("feature")
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.select(
        "feature", "value",
        F.sum("n").over(upto).alias("upto"),
        F.sum("n").over(whole).alias("all"),
        F.count(F.lit(1)).over(whole).alias("values"),
    )
    share = F.expr(f"(upto - 1) * {bins} div all")
    place = F.when(F.col("values") > bins, share).otherwise(F.col("upto"))
    ends = placed.groupBy("feature", place.alias("bin")).agg(F.max("value").alias("end"))
    found: list[list[float]] = [[] for _ in features]
    for row in ends.orderBy("feature", "end").collect():
        found[row.feature].append(row.end)
    return [np.array(own[:-1]) for own in found]


def draw_limits() -> np.ndarray:
    """A draw of 32 bits counts one for each limit that it reaches: a Poisson number of mean 1, 4 at most."""
    chance, limits = exp(-1), []
    for k in range(4):
        limits.append((limits[-1] if limits else 0.0) + chance / factorial(k))
    return np.array([int(x * 2**32) for x in limits], np.uint32)


def _draws(keys: list[str], growth: Growth) -> np.ndarray:
    """How often each tree draws each row: four trees from one MD5 of the key."""
    blocks = -(-growth.trees // 4)
    ends = [f"|{block}|{growth.seed}".encode() for block in range(blocks)]
    md5 = hashlib.md5
    data = b"".join([md5(key + end).digest() for key in (f"{k}".encode() for k in keys) for end in ends])
    bits = np.frombuffer(data, ">u4").reshape(len(keys), 4 * blocks)[:, : growth.trees]
    return np.searchsorted(draw_limits(), bits, side="right").astype(np.uint8)


def _columns(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    return [batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)]


def _packed(x: np.ndarray) -> pa.Array:
    ends = (np.arange(len(x) + 1) * x.shape[1]).astype(np.int32)
    data = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x, np.uint8))]
    return pa.Array.from_buffers(pa.binary(), len(x), data)


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    """The bytes of a column without nulls, ``width`` a row."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    _, ends, data = column.buffers()
    size = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    start = int(np.frombuffer(ends, size)[column.offset])
    return np.frombuffer(data, np.uint8, len(column) * width, start).reshape(-1, width)


def _prepared(rows: DataFrame, forest: Forest, growth: Growth) -> tuple[DataFrame, str]:
    """bins, draws (a byte for each feature and tree) and label of each row, written once."""
    flat, n = forest.flat(), len(forest.features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = _draws(batch.column(n + 1).to_pylist(), growth)
            bins = flat.bins(_columns(batch, n))
            yield pa.RecordBatch.from_arrays(
                [_packed(bins), _packed(draws), batch.column(n)], names=["bins", "draws", "label"]
            )

    inputs = [F.col(f).cast("double") for f in forest.features]
    narrow = spread(rows.select(*inputs, F.col("label").cast("int"), "key"))
    return write_shared(
        narrow.mapInArrow(pack, "bins binary, draws binary, label int"), "tree-rows"
    )


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over all cores if they lie in fewer partitions: a row is a few bytes and much work."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _may_try(forest: Forest, opened: list[int], tried: int, seed: int) -> np.ndarray:
    """Which features each open node may split by: those with the lowest MD5."""
    n = len(forest.features)
    allowed = np.ones((len(opened), n), bool)
    if tried < n:
        for i, at in enumerate(opened):
            own = f"{seed}|{forest.tree[at]}|{forest.node[at]}"
            digest = [hashlib.md5(f"{own}|{f}".encode()).digest() for f in range(n)]
            allowed[i] = False
            allowed[i, sorted(range(n), key=digest.__getitem__)[:tried]] = True
    return allowed


def _counts(rows: DataFrame, forest: Forest, opened: list[int], growth: Growth) -> DataFrame:
    """Rows drawn of each class by (place among ``opened``, feature, bin)."""
    flat, width = forest.flat(), max(map(len, forest.ends)) + 1
    allowed = _may_try(forest, opened, growth.tried, growth.seed)
    features, trees = len(forest.features), growth.trees
    tried = min(growth.tried, features)
    own_tree = np.array(forest.tree)[opened]
    # Of each open node the features that it tries; of each tree its open nodes, which are neighbours.
    slots = np.nonzero(allowed)[1].reshape(len(opened), tried)
    firsts, lasts = (np.searchsorted(own_tree, np.arange(trees), side) for side in ("left", "right"))
    place = np.full(len(forest.tree), -1)
    place[opened] = np.arange(len(opened)) - firsts[own_tree]
    names = ["open", "feature", "bin", "n0", "n1"]

    def tree_counts(
        tree: int, own_bins: np.ndarray, starts: np.ndarray, draws: np.ndarray, label: np.ndarray
    ) -> np.ndarray:
        """Rows drawn by (feature tried, open node of the tree, bin, label)."""
        drawn = np.flatnonzero(draws[tree])
        start = np.take(starts, drawn)
        node = np.take(place, flat.descend(tree, own_bins, start))
        if node.size and node.min() < 0:  # some rows are in leaves
            inner = np.flatnonzero(node >= 0)
            drawn, start, node = drawn[inner], start[inner], node[inner]
        times, size = np.take(draws[tree], drawn).astype(float), lasts[tree] - firsts[tree]
        first = node * (2 * width) + np.take(label, drawn)
        total = np.empty((tried, size * width * 2))
        for j, mine in enumerate(np.ascontiguousarray(slots[firsts[tree] : lasts[tree]].T)):
            code = np.take(own_bins, start + np.take(mine, node)) * np.intp(2) + first
            total[j] = np.bincount(code, times, total.shape[1])
        return total.astype(np.int64).reshape(tried, size, width, 2)

    def rows_of(tree: int, n: np.ndarray) -> pa.RecordBatch:
        j, k, b = np.nonzero(n.any(axis=3))
        n, k = n[j, k, b], k + firsts[tree]
        return pa.RecordBatch.from_arrays(
            [pa.array(k), pa.array(slots[k, j].astype(np.int32)), pa.array(b.astype(np.int32)),
             pa.array(n[:, 0]), pa.array(n[:, 1])],
            names=names,
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opens = np.flatnonzero(lasts > firsts).tolist()
        hold = len(opened) * tried * width * 2 <= HELD
        totals: dict[int, np.ndarray] = {}
        for chunk in _chunks(batches, CHUNK):
            bins, draws, label = _arrays(chunk, features, trees)
            arrays = *_flat_bins(bins), np.ascontiguousarray(draws.T), label
            for tree in opens:
                n = tree_counts(tree, *arrays)
                if not hold:
                    yield rows_of(tree, n)
                elif tree in totals:
                    totals[tree] += n
                else:
                    totals[tree] = n
        for tree, n in totals.items():
            yield rows_of(tree, n)

    found = rows.mapInArrow(count, "open bigint, feature int, bin int, n0 bigint, n1 bigint")
    return found.groupBy("open", "feature", "bin").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of at least ``rows`` rows, the last one of any number but none."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield held
            held, n = [], 0
    if n:
        yield held


def _arrays(batches: list[pa.RecordBatch], features: int, trees: int):
    return (
        np.concatenate([_unpacked(b.column("bins"), features) for b in batches]),
        np.concatenate([_unpacked(b.column("draws"), trees) for b in batches]),
        np.concatenate([b.column("label").to_numpy() for b in batches]).astype(np.int64),
    )


def gain(w0: Column, w1: Column, l0: Column, l1: Column) -> Column:
    """Fall of the Gini impurity from a node to the two sides of a split, from class weights."""

    def purity(a: Column, b: Column) -> Column:
        a, b = a.cast("double"), b.cast("double")
        return (a * a + b * b) / (a + b)

    fall = purity(l0, l1) + purity(w0 - l0, w1 - l1) - purity(w0, w1)
    return F.round(fall / (w0 + w1).cast("double"), DIGITS)


def best_splits(counts: DataFrame, weights: tuple[int, int], min_leaf: int) -> DataFrame:
    """open, feature, bin, gain, and the left side's l0 and l1 of the best split of each open node.

    Of equal gains the first feature wins, then the first bin. Nodes without a split are left out.
    """
    whole = Window.partitionBy("open", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = counts.select(
        "open", "feature", "bin",
        *[F.sum(c).over(whole).alias(c) for c in ("n0", "n1")],
        *[F.sum(f"n{k}").over(upto).alias(f"l{k}") for k in (0, 1)],
    )
    left = F.col("l0") + F.col("l1")
    fits = (left >= min_leaf) & (F.col("n0") + F.col("n1") - left >= min_leaf)
    weighed = [F.col(c) * F.lit(weights[int(c[1])]).cast("bigint") for c in ("n0", "n1", "l0", "l1")]
    sides = sides.where(fits).withColumn("gain", gain(*weighed)).where("gain > 0")
    order = F.struct("gain", -F.col("feature"), -F.col("bin"))
    best = F.max_by(F.struct("feature", "bin", "gain", "l0", "l1"), order)
    return sides.groupBy("open").agg(best.alias("best")).select("open", "best.*")


def grow(rows: DataFrame, features: list[str], growth: Growth) -> Forest:
    """Trees grown on ``rows`` (``features``, label 0 or 1, key), classes weighed to the same total.

    Rows with equal keys are drawn alike. Without rows every tree is a leaf of value 0.
    """
    if growth.bins > 256:
        raise ValueError("at most 256 bins")
    spark = rows.sparkSession
    totals = {int(r.label): r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # Thousandths of all / (2 n), rounded.
    weights = tuple((1000 * sum(totals.values()) + n) // (2 * n) if (n := totals.get(k, 0)) else 0
                    for k in (0, 1))
    ends = quantile_ends(rows, features, growth.bins)
    forest = Forest(features, ends, weights, growth.trees)
    packed, path = _prepared(rows, forest, growth)
    drawn = _drawn_totals(packed, growth.trees)
    opened = [forest.add(t, 1, 0, *drawn.get(t, (0, 0))) for t in range(growth.trees)]
    for level in range(growth.depth):
        opened = [at for at in opened if sum(forest.n[at]) >= 2 * growth.min_leaf]
        if not opened:
            break
        counts = _counts(packed, forest, opened, growth)
        found = best_splits(counts, weights, growth.min_leaf).orderBy("open").collect()
        parents, opened = opened, []
        for r in found:
            at = parents[r.open]
            n0, n1 = forest.n[at]
            forest.split[at] = (r.feature, r.bin, r.gain)
            tree, node = forest.tree[at], forest.node[at]
            forest.left[at] = forest.add(tree, 2 * node, level + 1, r.l0, r.l1)
            right = forest.add(tree, 2 * node + 1, level + 1, n0 - r.l0, n1 - r.l1)
            opened += [right - 1, right]
    drop_paths(spark, [path])
    return forest


def _drawn_totals(packed: DataFrame, trees: int) -> dict[int, tuple[int, int]]:
    """Rows drawn of each class, by tree."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((trees, 2), np.int64)
        for batch in batches:
            draws = _unpacked(batch.column(0), trees).astype(np.int64)
            label = batch.column(1).to_numpy()
            for k in (0, 1):
                n[:, k] += draws[label == k].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(trees, dtype=np.int32)), pa.array(n[:, 0]), pa.array(n[:, 1])],
            names=["tree", "n0", "n1"],
        )

    found = packed.select("draws", "label").mapInArrow(count, "tree int, n0 bigint, n1 bigint")
    sums = found.groupBy("tree").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    return {r.tree: (r.n0, r.n1) for r in sums.collect()}


def scores(forest: Forest) -> Column:
    """Mean share of class 1 in the leaves that a row comes to, as a column over the features."""
    flat, trees = forest.flat(), forest.trees

    @F.arrow_udf("bigint")
    def total(*columns: pa.Array) -> pa.Array:
        inputs = [c.to_numpy(zero_copy_only=False).astype(float) for c in columns]
        return pa.array(flat.score(flat.bins(inputs)))

    inputs = [F.col(f).cast("double") for f in forest.features]
    return total(*inputs).cast("double") / F.lit(float(UNIT * trees))


def importances(nodes: DataFrame, features: list[str], weights: tuple[int, int]) -> DataFrame:
    """Gini importance by feature from a node table: each tree's falls as shares, then their mean.

    Trees without a split do not count.
    """
    weight = F.col("n0") * F.lit(weights[0]) + F.col("n1") * F.lit(weights[1])
    falls = (
        nodes.where("gain IS NOT NULL")
        .groupBy("tree", "feature")
        .agg(F.sum(F.col("gain") * weight).alias("fall"))
    )
    share = F.col("fall") / F.sum("fall").over(Window.partitionBy("tree"))
    grown = falls.agg(F.count_distinct("tree")).scalar()
    means = falls.withColumn("share", share).groupBy("feature").agg(
        (F.sum("share") / grown).alias("importance")
    )
    names = F.posexplode(F.array(*map(F.lit, features))).alias("place", "name")
    every = nodes.sparkSession.range(1).select(names)
    return every.join(means, F.col("place") == F.col("feature"), "left").select(
        F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance")
    )


def mean_attributions(rows: DataFrame, forest: Forest) -> DataFrame:
    """feature, mean_size and mean (of the Shapley values of all ``rows``) by feature.

    Tasks return sums alone: a row for each feature and task.
    """
    flat, features = forest.flat(), forest.features

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((2, len(features)))
        for chunk in _chunks(batches, EXPLAINED):
            some = np.concatenate([flat.bins(_columns(batch, len(features))) for batch in chunk])
            bins, times = np.unique(some, axis=0, return_counts=True)
            own = flat.attributions(bins)
            total += np.stack([times @ np.abs(own), times @ own])
            n += len(some)
        yield pa.RecordBatch.from_arrays(
            [pa.array(features), pa.array([n] * len(features), pa.int64()), pa.array(total[0]),
             pa.array(total[1])],
            names=["feature", "n", "size", "total"],
        )

    inputs = [F.col(f).cast("double") for f in features]
    found = spread(rows.select(*inputs)).mapInArrow(sums, "feature string, n bigint, size double, total double")
    n = F.sum("n")
    return found.groupBy("feature").agg(
        F.try_divide(F.sum("size"), n).alias("mean_size"), F.try_divide(F.sum("total"), n).alias("mean")
    )


def row_attributions(rows: DataFrame, forest: Forest) -> Column:
    """An array of the Shapley values of a row by feature, as a column over the features."""
    flat = forest.flat()

    @F.arrow_udf("array<double>")
    def own(*columns: pa.Array) -> pa.Array:
        inputs = [c.to_numpy(zero_copy_only=False).astype(float) for c in columns]
        found = flat.attributions(flat.bins(inputs))
        ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

    return own(*[F.col(f).cast("double") for f in forest.features])
