import math

from corpus_fixtures import SMALL, prepared  # noqa: F401
import numpy as np
import pytest

from quadrille.llm.queries import QUERIES
from quadrille.llm.whitening import orthogonal_columns, pivoted_cholesky, principal, whiten


def brute(rows, components=16):
    """The contract by exact sums and a library's eigenvectors."""
    usable = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = sorted({len(x) for _, x in usable}, key=lambda d: (-sum(len(x) == d for _, x in usable), d))
    usable = [(i, x) for i, x in usable if len(x) == lengths[0]]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    found = {}
    for i, x in usable:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        z = np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ vectors
        for k in range(1, components + 1):
            if k <= len(values) and values[-k] > 1e-9 * values[-1]:
                found.setdefault((i, k), []).append((n, deviation, z[-k] / math.sqrt(values[-k]), values[-k] / values.sum()))
    return found


def held(found, want):
    sign, met = {}, {}
    rows = found.collect()
    assert len(rows) == sum(map(len, want.values()))
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    for r in rows:
        met.setdefault((r.vec_id, r.component), []).append(r)
    assert set(met) == set(want)
    for key, some in met.items():
        for r, (n, deviation, z, share) in zip(sorted(some, key=lambda r: r.deviation), sorted(want[key], key=lambda w: w[1])):
            assert (r.n, r.deviation) == (n, deviation) and abs(r.explained - share) <= 1e-9 * share
            if abs(z) > 1e-6:
                sign.setdefault(r.component, math.copysign(1, z * r.whitened))
            assert abs(r.whitened * sign.get(r.component, 1) - z) < 1e-6 * (1 + abs(z))


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    held(QUERIES["op13_whitening"](spark, SMALL), brute(rows))


@pytest.mark.parametrize("rank", [1, 3, 6, 20])
def test_factor_and_rotations(rank):
    rng = np.random.default_rng(rank)
    base = rng.normal(size=(rank, 20)) * 10.0 ** rng.uniform(-2, 2, (rank, 1))
    matrix = base.T @ base
    factor, order = pivoted_cholesky(matrix)
    assert factor.shape == (20, rank) and np.allclose(factor @ factor.T, matrix[np.ix_(order, order)], rtol=1e-10, atol=1e-9)
    assert np.allclose(np.triu(factor, 1), 0)
    turned = orthogonal_columns(factor)
    product = turned.T @ turned
    assert np.abs(product - np.diag(product.diagonal())).max() < 1e-13 * product.max()
    assert np.allclose(turned @ turned.T, factor @ factor.T, atol=1e-9)
    values, vectors = principal(matrix, 16)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:min(rank, 16)], rtol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert principal(np.zeros((3, 3)))[0].size == 0


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    rows = [(i, [*v, v[0], 0.5]) for i, v in rows]  # two entries without a direction of their own
    rows += [(3, rows[3][1]), (None, rows[4][1])] + [(100 + i, rows[7][1]) for i in range(500)]
    rows += [(900, None), (901, []), (902, [1.0] * 6 + [None]), (903, [float("nan")] * 7), (904, [float("inf")] * 7), (905, [1.0, 2.0])]
    docs = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<double>, x int, n int, component int").repartition(3)
    want = brute(rows)
    assert {k for _, k in want} == {1, 2, 3, 4, 5}
    held(whiten(docs), want)
    assert whiten(docs.limit(0)).count() == 0 and whiten(docs.where("vec_id = 7")).count() == 0


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [float(3 * i), float(i * i % 7)], 0) for i in range(30)] + [(99, [4e13, 0.0], 0)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.deviation for r in whiten(docs).collect()}
    assert got[99] is None
    rows = rows[:30]
    held(whiten(docs.where("vec_id < 99")), brute([(i, v) for i, v, _ in rows]))
