from corpus_fixtures import SMALL, made, prose, prepared  # noqa: F401
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from quadrille.llm.mixing import mix, source_targets, take
from quadrille.llm.queries import QUERIES, SQL


def test_query_equals_its_sql(spark):
    assert difference(QUERIES["op8_mixing"](spark, SMALL), connect(SMALL), SQL["op8_mixing"]) is None


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 50, "c": 0}, {"a": 5}, {"x": 1, "y": 1, "z": 1, None: 10_000}, {"é": 7, "z": 7, "Z": 900}])
def test_targets_by_sharing_the_excess_again_and_again(spark, sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = total - sum(2 * sizes[s] for s in full)
        target = {s: 2.0 * sizes[s] if s in full else free * weight[s] / sum(weight[t] for t in names if t not in full) for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s] + 1e-9}
        if not over:
            break
        full |= over
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    assert {r.source: pytest.approx(r.target) for r in rows} == target


def test_taken_words_and_odd_rows(spark, made, prose):
    docs = made([(i, prose(i % 40, i)) for i in range(300)] + [(None, "a b"), (7, "again"), (301, None), (302, ""), (303, "x " * 3000)])
    quality = spark.createDataFrame([(i, 4.0) for i in range(0, 300, 2)], "doc_id long, weight double")
    found = mix(docs, quality=quality, rows=16).cache()
    assert found.count() == 305 and found.where("taken > 2 * size").count() == 0
    for r in found.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect():
        assert abs(r.taken - r.target) <= r.most
    again = mix(docs.repartition(7), quality=quality, rows=1000)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, again.collect()))
    assert mix(docs.limit(0)).count() == 0


def test_good_documents_come_first(spark):
    docs = spark.createDataFrame([(i, "w", "s") for i in range(2000)] + [(5000 + i, "w " * 50, "t") for i in range(2000)], "doc_id long, text string, source string")
    quality = spark.createDataFrame([(i, 20.0) for i in range(0, 2000, 2)], "doc_id long, weight double")
    found = mix(docs, quality=quality, share=0.011).where("source = 's' AND copies > 0")
    assert found.where("doc_id % 2 = 0").count() > 4 * found.where("doc_id % 2 = 1").count()


def test_documents_are_repeated_as_planned(made):
    docs = made([(1, "a"), (2, "b"), (3, "c"), (None, "d")])
    plan = docs.select("doc_id", F.when(F.col("doc_id") == 1, 2).when(F.col("doc_id") == 2, 1).otherwise(0).alias("copies"))
    taken = take(docs, plan)
    assert taken.columns == docs.columns and sorted(r.doc_id for r in taken.collect()) == [1, 1, 2]
    every = docs.select("doc_id", F.lit(1).alias("copies"))
    assert take(docs, every).count() == 4 and take(docs.limit(0), every).count() == 0


def test_ranges_stay_even_for_any_weights(spark, monkeypatch):
    from quadrille.llm import mixing

    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    written, before = {}, mixing.cut
    monkeypatch.setattr(mixing, "cut", lambda df, name="cut": written.setdefault(name, before(df, name)))
    for weight in (0.05, 1.0, 30.0):
        written.clear()
        quality = docs.select("doc_id", F.lit(weight).alias("weight"))
        assert mix(docs, quality=quality, rows=5000).count() == 100_000
        assert written["ranges"].groupBy("_range").count().agg(F.max("count")).first()[0] <= 15_000
    written.clear()
    same = spark.range(30_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    mix(same, rows=1000).count()  # a third of all rows may be one row
    assert written["ranges"].groupBy("_range").count().agg(F.max("count")).first()[0] <= 3000


def test_rows_that_share_an_id(spark):
    rows = [(7, "one", "s"), (7, "one two three four five six seven eight nine", "s"), (None, "a b", "s"), (None, "a b c", "s"), (8, "x y z", "t"), (8, "x y z", "t"), (8, "x y z", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = set()
    for parts in (1, 2, 5):
        for share in (0.5, 1.0, 1.5):
            again = docs.repartition(parts)
            plan = mix(again, share=share).cache()
            taken = take(again, plan)
            words = {r.source: r.n for r in taken.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
            assert words == {r.source: r.n for r in plan.groupBy("source").agg(F.sum("taken").alias("n")).where("n > 0").collect()}
            seen.add((share, str(sorted(map(repr, plan.collect()))), str(sorted(map(repr, taken.collect())))))
    assert len(seen) == 3


def test_columns_of_any_name_survive(spark):
    docs = spark.createDataFrame([(k, f"w{k} x", "s", k, 2 * k, 3 * k, 4 * k, 5 * k) for k in range(20)] * 2,
                                 "doc_id long, text string, source string, _taken long, _copies long, _DOC long, _n long, _place long")
    taken = take(docs, mix(docs, share=2.0))
    assert taken.columns == docs.columns and sorted(map(tuple, taken.collect())) == sorted([tuple(r) for r in docs.collect()] * 2)
