import heapq
import math
import random

from corpus_fixtures import SMALL, prepared  # noqa: F401
import numpy as np

from quadrille.llm.neighbours import Family, _named, fitted, search
from quadrille.llm.queries import QUERIES


def brute(rows, queries, k=20):
    """The nearest by definition, over rows as the contract admits them."""
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    want = {}
    for q, v in queries:
        best = sorted((-float((np.array(v) * np.array(c)).sum()), i) for i, c in usable if i != q and len(c) == len(v))[:k]
        want[q] = [(i, -s) for s, i in best]
    return want


def share(found, want):
    rows = found.collect()
    met = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        met.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(met) == {q for q, w in want.items() if w}
    for q, got in met.items():
        assert got == sorted(got, key=lambda g: (-g[1], g[0])) and len(got) == len(want[q]) and q not in {i for i, _ in got}
        assert [r.rank for r in rows if r.query_id == q and r.rank == 1] == [1]
    return sum(len({i for i, _ in met[q]} & {i for i, _ in w}) for q, w in want.items() if w) / sum(map(len, want.values()))


def test_recall_of_the_query(spark):
    for folder in (SMALL, SMALL.replace("0.001", "0.1")):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
        want = brute(rows, [(i, v) for i, v in rows if i % 20 == 0])
        assert share(QUERIES["op11_nearest_neighbours"](spark, folder), want) >= 0.93


def test_probes_come_in_the_order_of_estimated_success():
    rng = np.random.default_rng(2)
    family, queries = Family.drawn(6, 2, 4, 1.0, 1.0), rng.normal(size=(5, 6))
    probes = family.probes(queries, 40)
    points = np.column_stack([queries / np.linalg.norm(queries, axis=1)[:, None], np.zeros(5)])
    for t in range(2):
        values = points @ family.directions[t].T + family.offsets[t]
        inside = values - np.floor(values)
        for q in range(5):
            every = []
            for steps in np.ndindex(5, 5, 5, 5):
                away = [0.0 if s == 2 else (inside[q, f] + (1 - s) if s < 2 else (1 - inside[q, f]) + (s - 3)) for f, s in enumerate(steps)]
                every.append(sum(a * a for a in away))
            least = heapq.nsmallest(40, every)
            cost = {}
            for steps, c in zip(np.ndindex(5, 5, 5, 5), every):
                places = np.floor(values[q]) + np.array([s - 2 for s in steps])
                cost[int(_named(places[None], t).sum(dtype=np.uint64))] = c
            own = family.rows(queries[q:q + 1] / np.linalg.norm(queries[q]))[0, t]
            assert probes[q, t, 0] == own and len(set(probes[q, t].tolist())) == 40
            assert np.allclose([cost[int(p)] for p in probes[q, t]], least)


def test_fit_reaches_its_goal():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(3000, 12))
    queries = rows[:40]
    near = [rows[np.argsort(-(rows @ q), kind="stable")[:20]] for q in queries]
    longest = float(np.sqrt((rows * rows).sum(1)).max())
    family, need = fitted(near, queries, rows[:500], 3000, longest)
    probes = family.probes(queries, need)
    hits = sum((family.rows(n)[:, :, None] == p[None]).any(axis=(1, 2)).sum() for n, p in zip(near, probes))
    assert hits >= 0.97 * 800


def test_odd_rows_and_hot_vectors(spark):
    rng, made = random.Random(4), np.random.default_rng(4)
    centre = made.normal(size=8)
    rows = [(i, (centre + 0.05 * made.normal(size=8)).tolist()) for i in range(300)]  # a crowded region
    rows += [(1000 + i, [rng.choice([0.0, 1.0, -1.0, 2.0]) for _ in range(8)]) for i in range(500)]  # many ties
    rows += [(2000 + i, rows[5][1]) for i in range(400)]  # a third of all rows are one vector
    rows += [(3000, None), (3020, [0.0] * 8), (3040, [1.0, None] + [0.0] * 6), (3060, [float("nan")] * 8), (3080, [float("inf")] * 8), (None, [9.0] * 8), (3100, [])]
    rows += [(4000, [1.0, 2.0]), (4020, [1.0, 1.0]), (4040, [3.0, 3.0]), (4060, [2.0]), (7, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rep int, code int").repartition(5)
    asked = [(i, v) for i, v in rows if i is not None and i % 20 == 0 and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    want = brute(rows, asked)
    queries = df.where("vec_id % 20 = 0")
    assert share(search(df, queries), want) >= 0.93
    # Small pieces and turns change nothing, and a query whose buckets are empty is searched in full.
    assert share(search(df, queries, part=64, chunk=16, turn=8), want) >= 0.93
    lone = spark.createDataFrame([(9000, [-50.0, 60.0, -70.0, 1.0, 2.0, 3.0, 90.0, -5.0])], "vec_id long, embedding array<double>")
    assert share(search(df, lone), brute(rows, [(9000, lone.first()[1])])) >= 0.9
    assert search(df.limit(0), queries).count() == 0 and search(df, queries.limit(0)).count() == 0
