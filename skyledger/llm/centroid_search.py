"""Centroid clustering with an equal-average equal-variance search for the nearest centroid.

Vectors are whole numbers, floor(1024 c). Centroids lie sorted by the mean of their components. A
vector's scan begins at its own mean and goes outward to the nearest mean not yet seen, on either
side. For d components with sums s, and u = sqrt(d) times the norm of what a vector has beside its mean,

    distance >= ((s_x - s_y)^2 + (u_x - u_y)^2) / d

so the scan ends once the first term alone is past the best distance, as all further means are
farther, and a centroid is passed over if both terms together are. Both bounds have slack for
rounding; what is left is compared by its distance in whole numbers, ties by the smaller number.

Each round is one pass: tasks send the counts and sums of every cluster, and only these, combined,
reach the driver, which holds the centroids. Their size is set by parameters, not by the rows.

Defined cases: vectors that are null, have another length, or hold a null or an entry that is not
finite are left out; so are those with an entry of ``LARGEST`` or more, whose squared distances
would not fit 64 bits. With fewer vectors than centroids there are as many centroids as vectors.
Start vectors with equal hashes (repeated ids) are ordered by their components; null ids come last.
Repeated rows and null ids come out as often as they come in; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import write_shared

SCALE, LENGTH = 1024, 64
CLUSTERS, ROUNDS, SALT = 8, 10, "3:"
#: 1024 times this, twice, squared and 64 times, is under 2**63.
LARGEST = float(1 << 17)
ROWS = 1 << 13
#: Slack of both bounds, relative and absolute.
SLACK = 1e-9


class Centroids:
    """Centroids sorted by their mean, for a search outward from a vector's own."""

    def __init__(self, points: np.ndarray) -> None:
        sums = points.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.points, self.sums = points[self.number], sums[self.number].astype(float)
        self.spread = _spread(self.points)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid; distances computed."""
        n, k, d = len(x), len(self.points), x.shape[1]
        sums, spread = x.sum(axis=1).astype(float), _spread(x)
        above = np.searchsorted(self.sums, sums)
        below = above - 1
        padded = np.concatenate([self.sums, [np.inf, -np.inf]])  # k is too high, -1 too low
        best = np.full(n, np.iinfo(np.int64).max)
        label, computed, live = np.full(n, k), 0, np.arange(n)
        while len(live):
            up, down = above[live], below[live]
            far_up, far_down = padded[up] - sums[live], sums[live] - padded[down]
            upward = far_up <= far_down
            at, gap = np.where(upward, up, down), np.minimum(far_up, far_down)
            above[live] += upward
            below[live] -= ~upward
            limit = d * (best[live] * (1 + SLACK) + 1)
            open_ = np.isfinite(gap) & (gap * gap <= limit)
            live, at, gap, limit = live[open_], at[open_], gap[open_], limit[open_]
            close = gap * gap + (spread[live] - self.spread[at]) ** 2 <= limit
            rows, at = live[close], at[close]
            apart = x[rows] - self.points[at]
            distance, number = np.einsum("ij,ij->i", apart, apart), self.number[at]
            computed += len(rows)
            better = distance < best[rows]
            better |= (distance == best[rows]) & (number < label[rows])
            best[rows[better]], label[rows[better]] = distance[better], number[better]
        return label, best, computed


def _spread(x: np.ndarray) -> np.ndarray:
    """sqrt(d) times the norm of each row less its mean."""
    beside = x - x.mean(axis=1, keepdims=True)
    return np.sqrt(x.shape[1] * np.einsum("ij,ij->i", beside, beside))


def whole_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and v, the vector in whole numbers, of the rows that take part."""
    entries = vectors.select("vec_id", F.col(column).cast("array<double>").alias("entries"))
    usable = F.forall(
        "entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    )
    v = F.transform("entries", lambda c: F.floor(F.lit(float(SCALE)) * c).cast("int"))
    return entries.where((F.size("entries") == LENGTH) & usable).select("vec_id", v.alias("v"))


def start(vectors: DataFrame, clusters: int = CLUSTERS, salt: str = SALT) -> np.ndarray:
    """The vectors with the smallest SHA-256 of salt and id, as the first centroids."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = vectors.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v")
    return np.array([r.v for r in first.limit(clusters).collect()], np.int64).reshape(-1, LENGTH)


def _matrices(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, matrix) of the vectors of a batch, some rows at a time."""
    for at in range(0, len(column), ROWS):
        some = column.slice(at, ROWS)
        yield at, some.flatten().to_numpy().astype(np.int64).reshape(len(some), LENGTH)


def _moved(vectors: DataFrame, points: np.ndarray) -> np.ndarray:
    """The centroids after one round: each the floor of its vectors' mean, empty ones as they were."""
    k = len(points)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, sums = Centroids(points), np.zeros((k, LENGTH + 1), np.int64)
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                label = centroids.nearest(x)[0]
                for c in np.unique(label):
                    own = x[label == c]
                    sums[c] += np.append(own.sum(axis=0), len(own))
        cluster, place = np.indices(sums.shape, np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster.ravel()), pa.array(place.ravel()), pa.array(sums.ravel())],
            names=["cluster", "place", "total"],
        )

    rows = vectors.select("v").mapInArrow(totals, "cluster int, place int, total bigint")
    found = np.zeros((k, LENGTH + 1), object)
    for cluster, place, total in rows.groupBy("cluster", "place").agg(F.sum("total")).collect():
        found[cluster, place] = total
    moved = points.copy()
    for c in range(k):
        if found[c, -1]:
            moved[c] = [total // found[c, -1] for total in found[c, :-1]]
    return moved


def fit(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT
) -> np.ndarray:
    """The centroids after ``rounds`` over ``vectors`` (vec_id, v), by number."""
    points = start(vectors, clusters, salt)
    for _ in range(rounds if len(points) else 0):
        points = _moved(vectors, points)
    return points


def assign(vectors: DataFrame, points: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of each of ``vectors`` (vec_id, v)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(points)
        for batch in batches:
            for at, x in _matrices(batch.column(1)):
                label, distance, _ = centroids.nearest(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(x)), pa.array(label.astype(np.int32)),
                     pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

    return vectors.select("vec_id", "v").mapInArrow(
        nearest, f"vec_id {kind}, cluster int, distance bigint"
    )


def cluster(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    salt: str = SALT,
    column: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector."""
    spark = embeddings.sparkSession
    vectors, _ = write_shared(whole_numbers(embeddings, column), "whole-vectors")
    points = fit(vectors, clusters, rounds, salt)
    assigned, _ = write_shared(assign(vectors, points), "assigned")
    digests = [(c, hashlib.sha256(",".join(map(str, p)).encode()).hexdigest())
               for c, p in enumerate(points.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = inertia.agg(F.sum("cluster_inertia")).scalar()
    # A row for each centroid.
    known = F.broadcast(inertia.join(named, "cluster").withColumn("inertia", total))
    return assigned.join(known, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
