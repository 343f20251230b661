import random

from corpus_fixtures import SMALL, made, prose, prepared  # noqa: F401
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quadrille.llm import near_join
from quadrille.llm.components import components
from quadrille.llm.near_join import block_count, drop_near_copies, least_matches, near_groups
from quadrille.llm.queries import QUERIES


def brute(pairs, n=5, threshold=0.8):
    sets = {}
    for i, t in pairs:
        w = (t or "").lower().encode().split()
        sets[i] = frozenset(tuple(w[p:p + n]) for p in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    ids, root, links = sorted(sets), {i: i for i in sets}, dict.fromkeys(sets, 0)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold:
                links[a], links[b] = links[a] + 1, links[b] + 1
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {i: (top(i), links[i]) for i in ids}


def edited(text, rng, times):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_clusters_larger_than_blocks_lose_no_link(made, prose, monkeypatch):
    monkeypatch.setattr(near_join, "BLOCK", 8)
    rng, pairs = random.Random(1), []
    for c in range(6):
        base = prose(150, c)
        pairs += [base if k % 5 == 0 else edited(base, rng, rng.randint(1, 4)) for k in range(30)]
    pairs = list(enumerate(pairs + [prose(60, 100 + k) for k in range(40)] + ["a b", "A B", "a", None, "", "", "one two three four five"]))
    found = {r.doc_id: (r.class_id, r.n_links) for r in near_groups(made(pairs)).collect()}
    assert found == brute(pairs)


def test_rows_sent_for_a_hot_bucket_grow_in_proportion(spark, monkeypatch):
    for name, value in {"TILE": 16, "BLOCKS": 8, "BLOCK": 64}.items():
        monkeypatch.setattr(near_join, name, value)
    sig = near_join.signature(near_join.shingles([b"a", b"b", b"c", b"d", b"e", b"f"])).tobytes()

    def sent(members):
        classes = spark.createDataFrame([(k, 1, 2, sig) for k in range(members)], "rep long, size long, n long, sig binary")
        tasks = near_join._tasks(classes).groupBy("band", "key", "i", "j").count().agg(F.sum("count"), F.max("count")).first()
        return tuple(tasks)

    (few, _), (many, most) = sent(160), sent(480)
    assert few == 24 * 8 * 160 and many == 3 * few and most <= 4 * 64


def test_blocks_of_a_bucket(spark):
    rows = [(2, 400), (256, 51_200), (1_000, 200_000), (10_000, 2_000_000), (100_000, 20_000_000), (1_000_000, 200_000_000), (100, 6_500_000), (2, 10**9)]
    found = spark.createDataFrame(rows, "members long, grams long").select(block_count(F.col("members"), F.col("grams")).alias("b")).collect()
    assert [r.b for r in found] == [1, 1, 4, 32, 32, 245, 4, 2]


@pytest.mark.parametrize("i, j", [(0, 0), (0, 1)])
def test_tiles_give_the_pairs_of_whole_blocks(monkeypatch, i, j):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**32, (4, near_join.HASHES), dtype=np.uint32)
    values = base[rng.integers(0, 4, 50)]
    values = np.where(rng.random(values.shape) < 0.1, rng.integers(0, 2**32, values.shape, dtype=np.uint32), values)
    band, sides = 3, rng.integers(0, 2, 50) * j
    table = pa.table({"band": [band] * 50, "i": [i] * 50, "j": [j] * 50, "side": sides})
    keys = near_join.band_keys(values)
    start = np.array([[(x < y if i == j else sides[x] < sides[y]) and not (keys[x, :band] == keys[y, :band]).any() for y in range(50)] for x in range(50)])
    want = {tuple(p) for p in near_join.likely_pairs(values, values, start, 0.8, 1e-7).tolist()}
    monkeypatch.setattr(near_join, "TILE", 7)
    found = [tuple(p) for pairs in near_join._candidates(table, values, 0.8, 1e-7) for p in pairs.tolist()]
    assert want and len(found) == len(set(found)) and set(found) == want


def test_odd_rows(spark, made, prose):
    long = " ".join(f"w{k}" for k in range(30_000))
    pairs = [(1, long), (2, long + " x"), (3, prose(50, 1)), (3, prose(50, 1)), (None, prose(50, 1)), (5, None), (6, " ")]
    rows = sorted(((r.doc_id, r.class_id, r.n_links) for r in near_groups(made(pairs)).collect()), key=repr)
    assert rows == sorted([(1, 1, 1), (2, 1, 1), (3, 3, 1), (3, 3, 1), (None, None, 0), (5, 5, 0), (6, 6, 0)], key=repr)
    kept = drop_near_copies(made(pairs))
    assert kept.columns == made(pairs).columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 3, 5, 6]
    assert near_groups(made(pairs).limit(0)).count() == 0


def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert {r.doc_id: (r.class_id, r.n_links) for r in QUERIES["op5_ngram_jaccard_join"](spark, SMALL).collect()} == brute(docs)


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    for compared in (24, 48, 72):
        assert (rng.binomial(compared, 0.8, 200_000) < least_matches(compared, 0.8, 1e-7)).sum() == 0
        assert (rng.binomial(compared, 0.1, 1000) >= least_matches(compared, 0.8, 1e-7)).mean() < 0.1


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(200, 200), (300, 299), (299, 300), (301, 299)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(1, 61)} | {100 + k: 100 for k in range(1, 40)} | {300: 299, 301: 299}
