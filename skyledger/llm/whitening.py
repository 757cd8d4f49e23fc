"""Whitening of embeddings: covariance by polarisation in whole numbers, then ``eigh``.

Entries become whole numbers x = floor(64 c) + 1,000,000. The model is fitted on every distinct
x-vector once. Sums come first; then every task aggregates squares of centred values
y = x - floor(mean), exactly, for each dimension and for the sum of each pair of dimensions:

    sum (y_i + y_j)^2 - sum y_i^2 - sum y_j^2 = 2 sum y_i y_j

The fraction that centring at a whole number leaves is put in on the driver in whole numbers too,
so each covariance is one correctly rounded division. What reaches the driver grows with the square
of the dimensions, never with the rows. ``identity_error`` is measured: a further pass whitens the
fit list and takes its covariance.

Tasks work in 64-bit numbers where these surely suffice and in Python's whole numbers elsewhere.

Defined cases: rows whose vector is null or holds a null or an entry that is not finite are left
out; so are rows with an entry of ``LARGEST`` or more, whose squares the sums cannot hold. Vectors of different
lengths are whitened apart, each length by its own fit list; an empty vector has no component.
Components that the fit list does not vary in (at rounding error) have null ``whitened``,
``explained`` as computed but at least 0, and no part in ``identity_error``. A ``deviation`` past 64 bits is null.
Repeated rows and null ids come out as often as they come in; other columns are ignored; an empty
table gives no rows. Equal eigenvalues leave the choice of their components to ``eigh``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import drop_paths, write_shared

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Entries below this stay below 2**41 as centred whole numbers, and 10**12 squares of pairs of
#: them below 10**38.
LARGEST = float(1 << 34)
#: Rows that are summed at once, and entries of them.
ROWS, ENTRIES = 4096, 1 << 18
TOTALS = "dims int, i int, j int, total decimal(38,0)"
_LONG = 1 << 63


@dataclass
class Axes:
    """The fitted space of one vector length."""

    n: int
    centre: np.ndarray  #: floor of the mean, by dimension
    rest: np.ndarray  #: n times the mean, less n times ``centre``
    values: np.ndarray  #: eigenvalues, falling
    vectors: np.ndarray  #: unit eigenvectors as rows
    explained: np.ndarray

    def varied(self) -> np.ndarray:
        """Which components the fit list varies in, beyond rounding error."""
        eps = np.finfo(float).eps * len(self.centre)
        return self.values > eps * max(float(self.values[0]), 0.0)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of rows of x; NaN on components without variance."""
        far = (x - self.centre) - self.rest / self.n
        scale = np.full(len(self.values), np.nan)
        scale[self.varied()] = 1 / np.sqrt(self.values[self.varied()])
        return (far @ self.vectors.T) * scale

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2 for each row of x."""
        y = x - self.centre
        bound = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if len(self.centre) * bound * bound < _LONG:
            far = y * self.n - self.rest
            return pa.array(np.einsum("ij,ij->i", far, far), pa.int64())
        far = y.astype(object) * self.n - self.rest.astype(object)
        return pa.array([v if v < _LONG else None for v in (far * far).sum(axis=1)], pa.int64())


def fixed_point(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x, the vector in whole numbers, of the rows whose entries all are finite."""
    entries = vectors.select("vec_id", F.col(column).cast("array<double>").alias("entries"))
    usable = F.forall(
        "entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    )
    x = F.transform("entries", lambda c: F.floor(F.lit(float(SCALE)) * c) + F.lit(OFFSET))
    return entries.where(F.col("entries").isNotNull() & usable).select("vec_id", x.alias("x"))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the vectors of each length, some rows at a time; empty ones are skipped."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        if not length:
            continue
        own = np.flatnonzero(lengths == length)
        step = int(min(ROWS, max(1, ENTRIES // length)))
        for at in range(0, len(own), step):
            rows = own[at : at + step]
            flat = column.take(pa.array(rows)).flatten()
            yield rows, flat.to_numpy(zero_copy_only=False).reshape(len(rows), length)


def _totals(add: Callable[[dict, np.ndarray], None], batches: Iterator[pa.RecordBatch]):
    """Run ``add`` over all matrices of a task; its dict (dims, i, j) -> total as rows."""
    totals: dict[tuple[int, int, int], int] = {}
    for batch in batches:
        for _, x in _matrices(batch.column(0)):
            add(totals, x)
    keys = np.array(list(totals), np.int32).reshape(-1, 3)
    sums = pa.array([Decimal(v) for v in totals.values()], pa.decimal128(38, 0))
    yield pa.RecordBatch.from_arrays(
        [*(pa.array(keys[:, k]) for k in range(3)), sums], names=["dims", "i", "j", "total"]
    )


def _collected(rows: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    """Totals of all tasks by length; their number grows with the dimensions alone."""
    found: dict[int, dict[tuple[int, int], int]] = {}
    sums = rows.groupBy("dims", "i", "j").agg(F.sum("total").alias("total"))
    for dims, i, j, total in sums.collect():
        found.setdefault(dims, {})[i, j] = int(total)
    return found


def _sums(fit: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    """Rows at (-1, -1) and the sum of dimension i at (i, -1), by length."""

    def add(totals: dict, x: np.ndarray) -> None:
        dims = x.shape[1]
        for i, v in enumerate([len(x), *x.sum(axis=0).tolist()], -1):
            totals[dims, i, -1] = totals.get((dims, i, -1), 0) + v

    return _collected(fit.select("x").mapInArrow(lambda b: _totals(add, b), TOTALS))


def _squares(fit: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, dict[tuple, int]]:
    """Sum of y_i^2 at (i, i) and of (y_i + y_j)^2 at (i, j), i < j, by length."""

    def add(totals: dict, x: np.ndarray) -> None:
        dims = x.shape[1]
        y = x - centres[dims]
        if int(np.abs(y).max()) >= 1 << 24:  # squares of pairs times ROWS pass 63 bits
            y = y.astype(object)
        for i in range(dims):
            pair = y[:, i:] + y[:, i : i + 1]
            pair[:, 0] = y[:, i]
            for j, v in enumerate((pair * pair).sum(axis=0).tolist(), i):
                totals[dims, i, j] = totals.get((dims, i, j), 0) + v

    return _collected(fit.select("x").mapInArrow(lambda b: _totals(add, b), TOTALS))


def _covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances, divisor n, from squares about ``centre`` and the remainders ``rest``.

    n^2 times a variance is n * sum y^2 - (sum y)^2, and the sums of y are the remainders.
    """
    dims = len(rest)
    single = [n * squares[i, i] - rest[i] ** 2 for i in range(dims)]
    found = np.empty((dims, dims))
    for i in range(dims):
        found[i, i] = single[i] / n**2
        for j in range(i + 1, dims):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            found[i, j] = found[j, i] = (both - single[i] - single[j]) / (2 * n**2)
    return found


def fit_axes(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Axes]:
    """The leading components of each vector length in ``fit`` (x), whose rows are distinct."""
    sums = _sums(fit)
    ns = {dims: own.pop((-1, -1)) for dims, own in sums.items()}
    totals = {dims: [own[i, -1] for i in range(dims)] for dims, own in sums.items()}
    centres = {d: np.array([s // ns[d] for s in own], np.int64) for d, own in totals.items()}
    found = {}
    for dims, squares in (_squares(fit, centres) if centres else {}).items():
        n, rest = ns[dims], [s % ns[dims] for s in totals[dims]]
        covariance = _covariance(n, rest, squares)
        values, vectors = np.linalg.eigh(covariance)
        first = slice(None, -min(components, dims) - 1, -1)
        trace = float(np.trace(covariance))
        values, vectors = values[first].copy(), np.ascontiguousarray(vectors.T[first])
        share = np.maximum(values, 0) / trace if trace else np.zeros(len(values))
        found[dims] = Axes(n, centres[dims], np.array(rest), values, vectors, share)
    return found


def identity_error(fit: DataFrame, axes: dict[int, Axes]) -> float:
    """Largest entry, in size, of the whitened fit list's covariance less the identity."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {dims: np.zeros((len(a.values) + 1, len(a.values))) for dims, a in axes.items()}
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                w = axes[x.shape[1]].whiten(x)
                sums[x.shape[1]][:-1] += w.T @ w
                sums[x.shape[1]][-1] += w.sum(axis=0)
        for dims, own in sums.items():
            i, j = np.indices(own.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(own.size, dims, np.int32)), pa.array(i.ravel().astype(np.int32)),
                 pa.array(j.ravel().astype(np.int32)), pa.array(own.ravel())],
                names=["dims", "i", "j", "total"],
            )

    rows = fit.select("x").mapInArrow(moments, "dims int, i int, j int, total double")
    found = {d: np.zeros((len(a.values) + 1, len(a.values))) for d, a in axes.items()}
    for dims, i, j, total in rows.groupBy("dims", "i", "j").agg(F.sum("total")).collect():
        found[dims][i, j] = total
    worst = 0.0
    for dims, own in found.items():
        mean = own[-1] / axes[dims].n
        off = own[:-1] / axes[dims].n - np.outer(mean, mean) - np.eye(len(mean))
        keep = axes[dims].varied()
        worst = max(worst, float(np.abs(off[np.ix_(keep, keep)]).max(initial=0.0)))
    return worst


def transform(fixed: DataFrame, axes: dict[int, Axes]) -> DataFrame:
    """vec_id, component, n, deviation, whitened and explained, a row for each component."""
    kind = fixed.schema["vec_id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _matrices(batch.column(1)):
                own = axes[x.shape[1]]
                white, k = own.whiten(x).ravel(), len(own.values)
                index = np.repeat(np.arange(len(rows)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[index])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(index), own.n)),
                        own.deviations(x).take(pa.array(index)),
                        pa.array(white, mask=np.isnan(white)),
                        pa.array(np.tile(own.explained, len(rows))),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained"],
                )

    return fixed.select("vec_id", "x").mapInArrow(
        project,
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double,"
        " explained double",
    )


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding"
) -> DataFrame:
    """``transform`` of all usable rows by axes fitted on them, and ``identity_error``."""
    fixed = fixed_point(vectors, column)
    fit, path = write_shared(fixed.select("x").distinct(), "fit-list")
    axes = fit_axes(fit, components)
    error = identity_error(fit, axes) if axes else 0.0
    drop_paths(vectors.sparkSession, [path])
    return transform(fixed, axes).withColumn("identity_error", F.lit(error))
