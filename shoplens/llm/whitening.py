"""Whitening of vectors: principal components by pivoted Cholesky and one-sided Jacobi rotations.

Entries become integers first, so everything that Spark sums is exact and no result depends on how the
rows are dealt. The covariance is fitted on the distinct vectors: a vector that a third of all rows repeat
counts once. Vectors are centred at the integer next to their mean before they are multiplied, and what is
left of the mean is taken off the sums in whole numbers. Only d (d + 1) / 2 sums reach the driver, which
factors the d by d matrix: V = L L' with diagonal pivoting, then rotations from the right make the columns
of L orthogonal. Their squared lengths are the eigenvalues, the columns divided by their lengths are the
components, and the matrix is never squared, so that small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.tables import pick
from shoplens.scratch import materialize

#: Entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Most entries of a vector; the sums that the driver gets grow with its square.
MAX_DIMENSIONS = 4_096
#: Rows multiplied at a time.
CHUNK = 4_096
#: Whole numbers below this are exact as doubles.
EXACT = 1 << 53


@dataclass
class Whitening:
    """n distinct vectors with sums S; the components with eigenvalues, largest first; the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    fit_list: DataFrame

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values


def whole(vector: Column) -> Column:
    """The entries as integers. One beyond the range of a long is an error."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)


def usable(vector: Column) -> Column:
    """The vector is there and all its entries are finite numbers."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


def integers(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, x of every usable row; x is the vector in integers."""
    wide = pick(rows, key=key, vector=vector).withColumn("vector", F.col("vector").cast("array<double>"))
    return wide.where(usable(F.col("vector"))).select("key", whole(F.col("vector")).alias("x"))


def _block(column: pa.Array, d: int) -> np.ndarray:
    """A column of integer lists as rows of d integers; what a shorter vector lacks counts as 0 before the shift."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == d).all():
        return flat.reshape(-1, d)
    out = np.full((len(lengths), d), SHIFT, dtype=np.int64)
    out[np.arange(d) < lengths[:, None]] = flat
    return out


def _chunks(batches, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            yield part, _block(part.column("x"), d)


def _summed(parts: DataFrame, kind: str) -> dict[int, object]:
    """Sums by place of what the tasks have summed already: as many rows as there are places."""
    return {r.place: r.total for r in parts.groupBy("place").agg(F.sum(F.col("value").cast(kind)).alias("total")).collect()}


def fit(x: DataFrame) -> Whitening:
    """Sums and components of the distinct vectors in column x."""
    fit_list = materialize(x.select("x").distinct(), "distinct-vectors")
    n, d = fit_list.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if d > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries, at most {MAX_DIMENSIONS} can be whitened")
    if not n or not d:
        return Whitening(n, [], np.zeros(0), np.zeros((d, 0)), 0.0, fit_list)

    def added(batches):
        total = np.zeros(d, dtype=object)
        for _, rows in _chunks(batches, d):
            total += _exact_sums(rows)
        yield _listed(total)

    sums = _summed(fit_list.mapInArrow(added, "place long, value string"), "decimal(38,0)")
    sums = [int(sums[i]) for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def products(batches):
        total = np.zeros((d, d), dtype=object)
        for _, rows in _chunks(batches, d):
            total += _exact_products(rows - np.array(centre, dtype=np.int64))
        yield _listed(total[np.triu_indices(d)])

    found = _summed(fit_list.mapInArrow(products, "place long, value string"), "decimal(38,0)")
    rest = [s - n * c for s, c in zip(sums, centre)]
    matrix = np.zeros((d, d))
    for place, (i, j) in enumerate(zip(*np.triu_indices(d))):
        # Whole numbers up to the division, which rounds once.
        matrix[i, j] = matrix[j, i] = (n * int(found[place]) - rest[i] * rest[j]) / (n * n)
    values, vectors = components(matrix)
    return Whitening(n, sums, values, vectors, float(np.trace(matrix)), fit_list)


def _listed(values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"place": pa.array(range(len(values)), pa.int64()), "value": pa.array([str(int(v)) for v in values])})


def _exact_sums(rows: np.ndarray) -> np.ndarray:
    if len(rows) and int(np.abs(rows).max()) * len(rows) >= 1 << 62:
        rows = rows.astype(object)
    return rows.sum(axis=0).astype(object)


def _exact_products(rows: np.ndarray) -> np.ndarray:
    """Sums of products in whole numbers: as doubles where these are exact, else in Python's integers."""
    top = int(np.abs(rows).max()) if len(rows) else 0
    if top * top * len(rows) < EXACT:
        small = rows.astype(np.float64)
        return (small.T @ small).astype(np.int64).astype(object)
    big = rows.astype(object)
    return big.T @ big


def components(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors in columns, of a positive semidefinite matrix: as many as its rank."""
    factor, order = pivoted_cholesky(matrix)
    rotated = one_sided_jacobi(factor)
    lengths = np.sqrt((rotated * rotated).sum(axis=0))
    by_size = np.argsort(-lengths, kind="stable")
    by_size = by_size[lengths[by_size] > 0]
    vectors = np.zeros((len(matrix), len(by_size)))
    vectors[order] = rotated[:, by_size] / lengths[by_size]
    return lengths[by_size] ** 2, vectors


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (d by rank) and order with matrix[order][:, order] = L L'. Stops where what is left is rounding."""
    left, d = matrix.copy(), len(matrix)
    order = np.arange(d)
    factor = np.zeros((d, d))
    least = d * np.finfo(float).eps * max(float(np.diag(matrix).max(initial=0.0)), 0.0)
    for k in range(d):
        pivot = k + int(np.argmax(np.diag(left)[k:]))
        if left[pivot, pivot] <= least:
            return factor[:, :k], order
        if pivot != k:
            left[[k, pivot]] = left[[pivot, k]]
            left[:, [k, pivot]] = left[:, [pivot, k]]
            factor[[k, pivot]] = factor[[pivot, k]]
            order[[k, pivot]] = order[[pivot, k]]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor times rotations that make its columns orthogonal to the last bits."""
    columns = factor.T.copy()  # a row of this array is a column, next to each other in memory
    limit = len(factor) * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for i in range(len(columns) - 1):
            for j in range(i + 1, len(columns)):
                a, b = columns[i], columns[j]
                aa, bb, ab = a @ a, b @ b, a @ b
                if abs(ab) <= limit * np.sqrt(aa * bb):
                    continue
                turned = True
                tau = (bb - aa) / (2 * ab)
                t = np.copysign(1.0, tau) / (abs(tau) + np.hypot(1.0, tau))
                c = 1 / np.hypot(1.0, t)
                columns[i], columns[j] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    return columns.T


def _whitener(model: Whitening, keep: int):
    """A function from rows of integers to exact deviations from the mean, times n, and whitened values."""
    d = len(model.sums)
    n, axes = model.n, model.vectors[:, :keep] / np.sqrt(model.values[:keep])
    sums = np.array(model.sums, dtype=object)
    reach = max((abs(s) for s in model.sums), default=0)

    def apply(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = int(np.abs(rows).max()) if len(rows) else 0
        if n * top + reach < 1 << 62:
            away = n * rows - sums.astype(np.int64)
        else:
            away = n * rows.astype(object) - sums
        return away, (away.astype(np.float64) / n) @ axes

    return apply, d


def identity_error(model: Whitening, keep: int = COMPONENTS) -> float:
    """Largest entry of the measured covariance of the whitened fit list minus the identity."""
    keep = min(keep, len(model.values))
    if not keep:
        return 0.0
    apply, d = _whitener(model, keep)
    corner = np.triu_indices(keep)

    def products(batches):
        total = np.zeros((keep, keep))
        for _, rows in _chunks(batches, d):
            white = apply(rows)[1]
            total += white.T @ white
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(corner[0])), pa.int64()), "value": pa.array(total[corner])})

    found = _summed(model.fit_list.mapInArrow(products, "place long, value double"), "double")
    return max(abs(found[place] / model.n - (i == j)) for place, (i, j) in enumerate(zip(*corner)))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: int = COMPONENTS) -> DataFrame:
    """key, component (from 1), n, deviation, whitened, explained, identity_error for every usable row.

    There are as many components as the covariance has eigenvalues above rounding, ``keep`` at most. Rows whose
    vector is null or has entries that are null or not finite are left out; rows without key stay. An empty vector
    and what a shorter one lacks count as zeros. Repeated rows and vectors stay repeated, but are fitted once. Ties
    among eigenvalues leave the choice of components within their span to the rotations, which do not depend on how
    rows are dealt. An empty table, or one whose vectors are all the same, has no components and gives no rows. A
    deviation that does not fit a long is an error.
    """
    x = materialize(integers(rows, key, vector), "integers")
    model = fit(x)
    keep = min(keep, len(model.values))
    apply, d = _whitener(model, keep)
    n, explained, error = model.n, model.explained[:keep], identity_error(model, keep)
    kind = x.schema["key"].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not keep:
        return x.limit(0).mapInArrow(lambda batches: iter(()), schema)

    def spread(batches):
        for batch, block in _chunks(batches, d):
            away, white = apply(block)
            if away.dtype == object or float(np.abs(away).max(initial=0)) ** 2 * d >= 2.0**62:
                deviation = [int((row * row).sum()) for row in away.astype(object)]
            else:
                deviation = (away * away).sum(axis=1)
            rows = len(block)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(np.repeat(np.arange(rows), keep))),
                    pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * keep, n, dtype=np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), keep))),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * keep, error)),
                ],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.mapInArrow(spread, schema)
