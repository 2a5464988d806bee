"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Method
------
1. *Points.* An entry ``c`` becomes the long ``floor(1024 * c) + 100000``.
   Count and sums per dimension are exact.
2. *Scatter.* Rows are centred by the rounded mean, an integer, before any
   multiplication; tasks add exact products and Spark sums one row per entry
   of the upper triangle. What the rounding left is taken off in exact
   integers, so the scatter does not depend on the partitioning.
3. *Factor.* Cholesky with diagonal pivoting gives a lower-trapezoidal factor
   of the scatter's numerical rank.
4. *Rotation.* One-sided Jacobi rotates the factor's columns until they are
   orthogonal; disjoint pairs of columns turn at once. Squared column norms
   are the eigenvalues, normalised columns the components. No eigenvalue
   passes through a squared matrix, so small ones keep their digits.
5. *Projection.* A second pass over the rows measures the whitened
   covariance (task moments, each centred on its own mean, merged pairwise in
   a fixed order); the last one projects.

Only the sums, the triangle and the components come to the driver: their size
depends on the dimension alone.

Results
-------
Rows whose vector is null or holds null or non-finite entries are left out,
also those with an entry past 64 bits as a long, and vectors that do not have
the most frequent length (of equally frequent ones, the longest). Repeated
rows and null ids are rows like any other. Components that have no variance
(rank below the number asked for) are not returned; without variance, or
without rows, there are none. Other columns are not read. ``deviation`` is
exact; where 64 bits cannot hold it, it is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1024  # fixed value: steps per unit
SHIFT = 100000  # fixed value: added to every step count
COMPONENTS = 8
LIMB = 60  # exact sums travel as two parts of this many low bits and the rest
EXACT = float(1 << 53)
_HALF_LONG = float(1 << 62)


def usable(vectors: DataFrame, ids: str, column: str) -> DataFrame:
    """``id, v`` of the rows that take part."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c * SCALE) >= F.lit(_HALF_LONG)))
    rows = vectors.select(F.col(ids).cast("long").alias("id"), v.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(True)))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("v") == (usual.d if usual else 0))


def steps_of(column: pa.Array) -> np.ndarray:
    """A batch of vectors as whole steps, rows by dimensions, without SHIFT."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), -1)


def _parts(values) -> tuple[list[int], list[int]]:
    values = [int(v) for v in values]
    return [v >> LIMB for v in values], [v & ((1 << LIMB) - 1) for v in values]


def _summed(rows: DataFrame) -> dict[int, int]:
    """Exact sums per ``key``: one row per key comes to the driver."""
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    return {r.key: (int(r.high) << LIMB) + int(r.low) for r in rows.groupBy("key").agg(*wide).collect()}


def _batch(keys, values) -> pa.RecordBatch:
    high, low = _parts(values)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([str(h) for h in high]), pa.array(low, pa.int64())],
        ["key", "high", "low"])


SUMS = "key long, high string, low long"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's count (key -1) and sums per dimension."""
    n, total = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        steps = steps_of(batch.column(0))
        wide = np.abs(steps).max(initial=0) * float(len(steps)) >= _HALF_LONG
        own = steps.astype(object).sum(axis=0) if wide else steps.sum(axis=0)
        own = own.astype(object)
        n, total = n + len(steps), own if total is None else total + own
    if n:
        yield _batch([-1, *range(len(total))], [n, *total])


def products(centred: np.ndarray) -> np.ndarray:
    """The exact sum of outer products of integer rows, as Python integers."""
    most = float(np.abs(centred.astype(np.float64)).max(initial=0.0))
    if most * most * len(centred) < EXACT:  # every partial sum is a whole double
        real = centred.astype(np.float64)
        return (real.T @ real).astype(np.int64).astype(object)
    whole = centred.astype(object)
    return whole.T @ whole


def _scatter(centre: list[int]):
    """A task's upper triangle of products and (below zero) sums, centred."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, total, rest = np.array(centre, np.int64), None, None
        for batch in batches:
            steps = steps_of(batch.column(0))
            for at in range(0, len(steps), 4096):
                own = steps[at:at + 4096] - middle
                made, left = products(own), own.astype(object).sum(axis=0)
                total, rest = (made, left) if total is None else (total + made, rest + left)
        if total is not None:
            d = len(centre)
            upper = np.triu_indices(d)
            yield _batch([*(upper[0] * d + upper[1]), *range(-d, 0)], [*total[upper], *rest])

    return run


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``L`` with ``a = L L'`` in the rows' own order: the largest remaining
    diagonal entry is the next pivot; it ends where rounding is all that is
    left."""
    left = a.copy()
    d = len(left)
    order, factor = np.arange(d), np.zeros((d, d))
    floor = d * np.finfo(float).eps * max(left.diagonal().max(initial=0.0), 0.0)
    rank = 0
    while rank < d:
        pivot = rank + int(np.argmax(left.diagonal()[rank:]))
        if not left[pivot, pivot] > floor:
            break
        for m in (left, factor):
            m[[rank, pivot]] = m[[pivot, rank]]
        left[:, [rank, pivot]] = left[:, [pivot, rank]]
        order[[rank, pivot]] = order[[pivot, rank]]
        root = np.sqrt(left[rank, rank])
        factor[rank, rank] = root
        factor[rank + 1:, rank] = left[rank + 1:, rank] / root
        left[rank + 1:, rank + 1:] -= np.outer(factor[rank + 1:, rank], factor[rank + 1:, rank])
        rank += 1
    out = np.empty((d, rank))
    out[order] = factor[:, :rank]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times a rotation that makes its columns orthogonal. A sweep
    meets every pair once, in rounds of disjoint pairs."""
    columns = np.ascontiguousarray(factor.T)
    r = len(columns)
    if r < 2:
        return columns.T
    players = list(range(r)) + ([-1] if r % 2 else [])
    half = len(players) // 2
    limit = np.finfo(float).eps * np.sqrt(factor.shape[0])
    for _ in range(sweeps):
        worst, ring = 0.0, players[:]
        for _ in range(len(players) - 1):
            pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1]) if a >= 0 and b >= 0]
            p, q = np.array(pairs).T
            x, y = columns[p], columns[q]
            a, b, c = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            size = np.sqrt(a * b)
            cosine = np.divide(np.abs(c), size, out=np.zeros_like(c), where=size > 0)
            worst = max(worst, float(cosine.max()))
            turn = cosine > limit
            zeta = (b[turn] - a[turn]) / (2 * c[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.sqrt(1 + t * t)
            cos, sin = cos[:, None], (cos * t)[:, None]
            columns[p[turn]], columns[q[turn]] = cos * x[turn] - sin * y[turn], sin * x[turn] + cos * y[turn]
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst <= limit:
            break
    return columns.T


@dataclass(frozen=True)
class Whitening:
    """A fitted transform; arrays are of the dimension's size."""

    n: int
    centre: list[int]  # whole steps next to the mean
    rest: list[int]  # sums of what the centre leaves, per dimension
    values: np.ndarray  # all eigenvalues, falling
    components: np.ndarray  # one component a row, all that have variance
    trace: float

    @property
    def rank(self) -> int:
        return len(self.values)

    def project(self, steps: np.ndarray, k: int) -> np.ndarray:
        offset = np.array([r / self.n for r in self.rest])
        centred = (steps - np.array(self.centre, np.int64)).astype(np.float64) - offset
        return centred @ (self.components[:k] / np.sqrt(self.values[:k, None])).T

    def deviations(self, steps: np.ndarray) -> list[int]:
        """Exact squared distances from the mean, times ``n * n``."""
        centred = steps - np.array(self.centre, np.int64)
        most, rest = float(np.abs(centred.astype(np.float64)).max(initial=0.0)), np.array(self.rest, object)
        bound = max([1, *(abs(r) for r in self.rest)])
        if max(most * most, most * bound) * centred.shape[1] < _HALF_LONG:
            squares = (centred * centred).sum(1).tolist()
            crossed = (centred @ np.array(self.rest, np.int64)).tolist()
        else:
            whole = centred.astype(object)
            squares, crossed = (whole * whole).sum(1).tolist(), (whole @ rest).tolist()
        own = int((rest * rest).sum())
        return [self.n * self.n * s - 2 * self.n * c + own for s, c in zip(squares, crossed)]


def fit(rows: DataFrame) -> Whitening | None:
    """The transform of all ``rows`` (of ``usable``); None without rows."""
    vectors = rows.select("v")
    sums = _summed(vectors.mapInArrow(_sums, SUMS))
    if not sums:
        return None
    n, d = sums[-1], len(sums) - 1
    centre = [(2 * sums[i] + n) // (2 * n) for i in range(d)]
    found = _summed(vectors.mapInArrow(_scatter(centre), SUMS))
    rest = [found[i - d] for i in range(d)]
    covariance = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            covariance[i, j] = covariance[j, i] = (n * found[i * d + j] - rest[i] * rest[j]) / (n * n)
    turned = one_sided_jacobi(pivoted_cholesky(covariance))
    values = (turned * turned).sum(0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > 0]
    components = (turned[:, order] / np.sqrt(values[order])).T
    if len(components):
        largest = components[np.arange(len(components)), np.abs(components).argmax(1)]
        components = components * np.where(largest < 0, -1.0, 1.0)[:, None]
    return Whitening(n, centre, rest, values[order], components, float(np.trace(covariance)))


MOMENTS = "place long, n long, mean array<double>, moment array<double>"


def _moments(model: Whitening, k: int):
    """A task's count, mean and centred second moments of whitened rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = None
        for batch in batches:
            if batch.num_rows:
                own = model.project(steps_of(batch.column(0)), k)
                mean = own.mean(0)
                held = merged(held, (len(own), mean, (own - mean).T @ (own - mean)))
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([held[0]], pa.int64()),
                 pa.array([held[1].tolist()], pa.list_(pa.float64())),
                 pa.array([held[2].ravel().tolist()], pa.list_(pa.float64()))],
                ["place", "n", "mean", "moment"])

    return run


def merged(a: tuple | None, b: tuple | None) -> tuple | None:
    """Two parts' count, mean and centred moments as one."""
    if a is None or b is None:
        return a or b
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _merge_group(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["place"])
        held = None
        for r in rows:
            held = merged(held, (r["n"], np.array(r["mean"]), np.array(r["moment"]).reshape(k, k)))
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[0]["place"]], pa.int64()), pa.array([held[0]], pa.int64()),
                 pa.array([held[1].tolist()], pa.list_(pa.float64())),
                 pa.array([held[2].ravel().tolist()], pa.list_(pa.float64()))],
                ["place", "n", "mean", "moment"])

    return run


def identity_error(rows: DataFrame, model: Whitening, k: int, groups: int = 16) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the
    identity. Task moments (``k * k`` numbers each) merge in ``groups`` parts
    before the driver merges those."""
    parts = rows.select("v").mapInArrow(_moments(model, k), MOMENTS)
    parts = parts.repartitionById(groups, (F.col("place") % groups).cast("int")).mapInArrow(_merge_group(k), MOMENTS)
    held = None
    for r in sorted(parts.collect(), key=lambda r: r.place):
        held = merged(held, (r.n, np.array(r.mean), np.array(r.moment).reshape(k, k)))
    return float(np.abs(held[2] / held[0] - np.eye(k)).max()) if held and k else 0.0


def whiten(rows: DataFrame, model: Whitening, k: int) -> DataFrame:
    """``id, deviation, whitened`` (an array of the first ``k`` components)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                steps = steps_of(part.column(1))
                far = [v if v < 1 << 63 else None for v in model.deviations(steps)]
                own = model.project(steps, k)
                ends = pa.array(np.arange(0, own.size + 1, k, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(far, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(own.ravel()))],
                    ["id", "deviation", "whitened"])

    return rows.select("id", "v").mapInArrow(run, "id long, deviation long, whitened array<double>")


def whitened_components(vectors: DataFrame, ids: str = "vec_id", column: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: the columns of op11."""
    rows = usable(vectors, ids, column)
    model = fit(rows)
    k = min(components, model.rank) if model else 0
    if not k:
        return vectors.sparkSession.createDataFrame(
            [], f"{ids} long, component int, n long, deviation long, whitened double, explained double, "
                "identity_error double")
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:k]])
    error = identity_error(rows, model, k)
    return whiten(rows, model, k).select(
        F.col("id").alias(ids), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        ids, (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"))
