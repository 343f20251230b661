"""Whitening of embeddings: principal components with unit variance, from integers.

Components of vectors are turned into integers, so equal vectors are equal, sums are exact and the squared distance from
the mean is an exact number. The centred scatter of the different vectors is summed by tasks; a pivoted Cholesky factorisation
gives its rank and a triangular factor, and one-sided Jacobi rotations make the columns of that factor orthogonal: their squared
lengths are the eigenvalues, and their directions the components. The scatter itself is never squared or inverted.

The driver holds one matrix of ``dims`` times ``dims`` numbers, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import column

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Pivots and eigenvalues below this share of the largest one count as zero.
RANK = 1e-13
#: Vectors that a task multiplies at a time.
BLOCK = 4096


def integers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """``floor(scale * c) + offset`` of each entry as long; null where the vector or an entry is null or not finite, or there is no entry."""
    wide = vector.cast("array<double>")
    usable = (F.size(wide) > 0) & F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(usable, F.transform(wide, lambda c: F.floor(c * scale) + offset))


def pivoted_cholesky(matrix: np.ndarray, tolerance: float = RANK) -> tuple[np.ndarray, np.ndarray]:
    """``(factor, order)``: ``factor @ factor.T`` is ``matrix`` with rows and columns in ``order``; lower trapezoidal, a column per rank.

    The largest remaining diagonal entry comes first; the factorisation ends when it is no more than ``tolerance`` times the first.
    """
    rest, size = matrix.astype(float).copy(), len(matrix)
    order, factor = np.arange(size), np.zeros((size, size))
    first = rest.diagonal().max(initial=0.0)
    for step in range(size):
        pivot = step + int(np.argmax(rest.diagonal()[step:]))
        if not rest[pivot, pivot] > tolerance * first:
            return factor[:, :step], order
        swap = [pivot, step]
        rest[[step, pivot]], order[[step, pivot]], factor[[step, pivot]] = rest[swap], order[swap], factor[swap]
        rest[:, [step, pivot]] = rest[:, swap]
        column_ = rest[step:, step] / np.sqrt(rest[step, step])
        factor[step:, step] = column_
        rest[step + 1:, step + 1:] -= np.outer(column_[1:], column_[1:])
    return factor, order


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor after one-sided Jacobi rotations from the right: all columns orthogonal to double precision.

    Pairs that share no column are rotated together, in the rounds of a tournament in which every column meets every other.
    """
    work, count = factor.copy(), factor.shape[1]
    if count < 2:
        return work
    ring = np.arange(count + count % 2)  # an odd column sits out one round
    for _ in range(sweeps):
        turned = 0.0
        for _ in range(len(ring) - 1):
            left, right = ring[:len(ring) // 2], ring[len(ring) // 2:][::-1]
            real = (left < count) & (right < count)
            a, b = left[real], right[real]
            x, y = work[:, a], work[:, b]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(xx * yy)
            turn = np.abs(xy) > 1e-15 * size
            turned = max(turned, float(np.max(np.abs(xy[turn]) / size[turn], initial=0.0)))
            half = np.where(turn, (yy - xx) / np.where(turn, 2 * xy, 1.0), 0.0)
            tangent = np.where(turn, np.where(half < 0, -1.0, 1.0) / (np.abs(half) + np.sqrt(1 + half * half)), 0.0)
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            work[:, a], work[:, b] = cosine * x - sine * y, sine * x + cosine * y
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if turned <= 1e-15:
            break
    return work


def principal(scatter: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors (columns) of a positive semidefinite matrix, as far as its rank reaches.

    The entry of largest size in a component is positive, so reruns give the same signs.
    """
    factor, order = pivoted_cholesky(scatter)
    columns = np.zeros_like(factor)
    columns[order] = orthogonal_columns(factor)
    values = (columns * columns).sum(0)
    best = np.argsort(-values, kind="stable")[:count]
    values, vectors = values[best], columns[:, best] / np.sqrt(values[best])
    if vectors.size:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return values, vectors


def _matrix(batch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _blocks(batches) -> Iterator[np.ndarray]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield _matrix(batch.slice(start, BLOCK))


def _summed(rows: DataFrame, cells, dims: int, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of ``cells(matrix)`` over all blocks of ``rows``: each task sends one array, cut into numbered rows."""
    import pyarrow as pa

    def run(batches):
        total = 0.0
        for block in _blocks(batches):
            total = total + cells(block)
        if isinstance(total, np.ndarray):
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat.astype(float))], ["cell", "part"])

    found = rows.mapInArrow(run, "cell long, part double").groupBy("cell").agg(F.sum("part").alias("total")).collect()
    result = np.zeros(int(np.prod(shape)))
    for r in found:
        result[r["cell"]] = r["total"]
    return result.reshape(shape)


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per usable row of ``vectors`` and component.

    Rows whose vector is null or empty, or has null or non-finite entries, take no part, and neither do those of another length than
    most rows have (of equally common lengths, the shorter). The mean and the components are fitted on each different integer vector
    once, so copies do not pull them; every usable row is then projected, repeated rows and null ids each. There are no more
    components than the rank of the covariance: none, and so no rows, where all vectors are equal, and an empty result for an empty table.
    ``deviation`` is exact, and null where it does not fit a long. The driver receives ``dims`` sums and ``dims * (dims + 1) / 2`` products.
    """
    import pyarrow as pa

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = vectors.select(column(id).cast("long").alias("vec_id"), integers(column(vector), scale, offset).alias("x")).where("x IS NOT NULL")
    lengths = found.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "dims").limit(1).collect()
    if not lengths:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = lengths[0]["dims"]
    found = found.where(F.size("x") == dims)
    fit = cut(found.select("x").distinct(), "fit")
    # Sums of longs, exact: per task as numbers, over tasks as decimals.
    n, sums = _exact_sums(fit, dims)
    base = np.array([(2 * s + n) // (2 * n) for s in sums])  # the mean rounded
    rest = np.array([(s - n * int(b)) / n for s, b in zip(sums, base)])  # and what rounding left out
    upper = np.triu_indices(dims)

    def products(x: np.ndarray) -> np.ndarray:
        centred = (x - base) - rest
        return (centred.T @ centred)[upper]

    scatter = np.zeros((dims, dims))
    scatter[upper] = _summed(fit, products, dims, (len(upper[0]),))
    scatter = scatter + np.triu(scatter, 1).T
    values, axes = principal(scatter, components)
    count = len(values)
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    deviations, explained = np.sqrt(values / n), values / scatter.trace()

    def projected(x: np.ndarray) -> np.ndarray:
        return (((x - base) - rest) @ axes) / deviations

    def moments(x: np.ndarray) -> np.ndarray:
        z = projected(x)
        return np.vstack([z.T @ z, z.sum(0)])

    moment = _summed(fit, moments, dims, (count + 1, count))
    mean = moment[-1] / n
    error = float(np.abs(moment[:-1] / n - np.outer(mean, mean) - np.eye(count)).max())
    sums64 = sums

    def rows(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                x = _matrix(part)
                z, exact, size = projected(x), _deviations(x, n, sums64), part.num_rows
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(size), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)), pa.array(np.full(size * count, n, np.int64)),
                    exact.take(pa.array(np.repeat(np.arange(size), count))), pa.array(z.ravel()),
                    pa.array(np.tile(explained, size)), pa.array(np.full(size * count, error)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return found.mapInArrow(rows, schema)


def _exact_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""
    import pyarrow as pa

    def run(batches):
        rows, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for x in _blocks(batches):  # halves of 32 bits: no sum of a task overflows
            rows, high, low = rows + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, dims)), pa.array(np.append(0, high)), pa.array(np.append(rows, low))], ["dim", "high", "low"])

    wide = "decimal(38,0)"
    found = fit.mapInArrow(run, "dim long, high long, low long").groupBy("dim").agg(
        F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")).collect()
    totals = {r["dim"]: (int(r["high"]) << 32) + int(r["low"]) for r in found}
    return totals[-1], [totals[d] for d in range(dims)]


def _deviations(x: np.ndarray, n: int, sums: list[int]):
    """``sum((n * x - sums) ** 2)`` per row, exact; null beyond a long."""
    import pyarrow as pa

    near = np.array([s / n for s in sums])
    size = (((x - near) * float(n)) ** 2).sum(1)
    largest = float(np.abs(x).max(initial=0)) * n
    if size.max(initial=0.0) < 2.0**62 and largest < 2.0**62:
        apart = x * np.int64(n) - np.array(sums, np.int64)
        return pa.array((apart * apart).sum(1))
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([e if e < 2**63 else None for e in exact], pa.int64())
