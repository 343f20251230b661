import random
import re
import time

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from fixtures import SW, starwars_quads
from quadrille.model import DEFAULT_GRAPH, QUAD, RDF_TYPE, XSD_INTEGER, Lit, Val, quads
from quadrille.operators.caches import Cache, CachedMatch, bulk_quads, cached_graph, cached_query
from quadrille.operators.documents import DocumentStore, delete, documents, lookup, size, upsert
from quadrille.operators.graph import Dataset, Pattern, StoredGraph
from quadrille.operators.patterns import bgp
from quadrille.operators.store import BucketedGraph, GraphStore, restore, stored_graph, write_quads
from quadrille.session import cut, scratch

ONE = [("urn:subj", "urn:pred", "urn:obj")]
SPO = [Pattern("?s", "?p", "?o")]
G1, G2, G3 = "http://graph1", "http://graph2", "http://graph3"


@pytest.fixture
def store(spark):
    return GraphStore.create(spark, scratch(spark))


def two_graphs(spark):
    return quads(spark, [("ex:a", "ex:b", "ex:c", G1), ("ex:d", "ex:e", "ex:f", G1), ("ex:g", "ex:h", "ex:i", G2)])


def n(store, *graphs):
    return bgp(store.graph(), SPO, Dataset.of(default=graphs) if graphs else Dataset()).count()


def test_commit_counts(spark, store):
    data = quads(spark, ONE)
    assert store.begin().clear().add(data).commit() == {"added": 1, "removed": 0}
    assert store.begin().add(data).commit() == {"added": 0, "removed": 0}
    assert store.begin().remove(data).commit() == {"added": 0, "removed": 1}
    assert store.begin().remove(data).commit() == {"added": 0, "removed": 0}
    assert store.begin().remove(data).add(data).commit() == {"added": 1, "removed": 0}
    assert store.begin().add(data).remove(data).commit() == {"added": 0, "removed": 1}
    assert store.begin().commit() == {"added": 0, "removed": 0}
    assert store.size().first()["n"] == store.size_estimate().first()["n"] == 0


def test_remove_touches_one_graph_only(spark, store):
    data = quads(spark, ONE)
    store.begin().add(data, "urn:graph").commit()
    store.begin().remove(data).commit()
    assert store.size().first()["n"] == 1
    store.begin().remove(data, "urn:graph").commit()
    assert store.size().first()["n"] == 0


def test_staged_reads_and_rollback(spark, store):
    batch = store.begin().add(starwars_quads(spark))
    assert bgp(batch.graph(), [Pattern("?s", SW + "name", Lit("Luke Skywalker"))]).count() == 1
    assert store.size().first()["n"] == 0
    batch.rollback()
    assert store.size().first()["n"] == 0
    with pytest.raises(RuntimeError):
        batch.commit()
    batch = store.begin().add(starwars_quads(spark))
    batch.commit()
    assert store.size().first()["n"] == store.size_estimate().first()["n"] == 90
    batch = store.begin()
    batch.delete_where(bgp(batch.graph(), SPO), SPO)
    assert bgp(batch.graph(), SPO).count() == 0 and store.size().first()["n"] == 90
    assert batch.commit() == {"added": 0, "removed": 90}
    assert store.size().first()["n"] == store.size_estimate().first()["n"] == 0


def test_the_flag_of_the_batch_decides_on_reasoning(spark, store):
    store.begin().add(starwars_quads(spark)).commit()
    character = [Pattern("?s", RDF_TYPE, SW + "Character")]
    assert bgp(store.begin().graph(reasoning=True), character).count() == 0
    assert bgp(store.begin(reasoning=True).graph(reasoning=True), character).count() == 8
    assert bgp(store.begin(reasoning=True).graph(), character).count() == 8


def test_insert_where_with_using_graphs(spark, store):
    store.begin().add(two_graphs(spark)).commit()
    assert n(store, G1) == 2
    batch = store.begin()
    batch.insert_where(bgp(batch.graph(), SPO, Dataset.of(default=[G1])), [Pattern("?s", "urn:z", "?o", G1)]).commit()
    assert (n(store, G1), n(store, G2)) == (4, 1)
    batch = store.begin()
    batch.insert_where(bgp(batch.graph(), SPO, Dataset.of(default=[G1, G2])), [Pattern("?s", "?p", "?o", G3)]).commit()
    assert n(store, G3) == 5


def test_insert_where_with_named_graphs(spark, store):
    store.begin().add(two_graphs(spark)).commit()
    batch = store.begin()
    found = bgp(batch.graph(), [Pattern("?s", "?p", "?o", "?g")], Dataset.of(named=[G1, G2]))
    batch.insert_where(found, [Pattern("?s", "?p", "?o", G3)]).commit()
    assert n(store, G3) == 3


def test_insert_and_delete_data_with_target_graph(spark, store):
    data = quads(spark, [("ex:a", "ex:b", "ex:c"), ("ex:d", "ex:e", "ex:f")])
    store.begin().add(data, "http://my-graph").commit()
    assert n(store, "http://my-graph") == 2
    store.begin().remove(data, "http://my-graph").commit()
    assert n(store, "http://my-graph") == 0


def test_clear_one_graph(spark, store):
    store.begin().add(two_graphs(spark)).commit()
    assert store.begin().clear(G1).commit() == {"added": 0, "removed": 2}
    assert store.begin().clear().commit() == {"added": 0, "removed": 1}


def test_two_commits_on_one_version_do_not_both_succeed(spark, store):
    first, second = store.begin(), store.begin()
    first.add(quads(spark, ONE)).commit()
    with pytest.raises(Exception):
        second.add(quads(spark, [("urn:x", "urn:y", "urn:z")])).commit()
    assert store.size().first()["n"] == 1
    store.begin().add(quads(spark, [("urn:x", "urn:y", "urn:z")])).commit()
    assert store.size().first()["n"] == 2


def test_compact_keeps_the_content(spark, store):
    store.begin().add(two_graphs(spark)).commit()
    store.begin().add(starwars_quads(spark)).remove(quads(spark, [("ex:a", "ex:b", "ex:c")]), G1).commit()
    before = rows(store.quads(), *QUAD)
    store.compact()
    assert store.current()[2] == [] and rows(store.quads(), *QUAD) == before and len(before) == 92
    scan = bgp(store.graph(), [Pattern("?s", SW + "name", "?n")])
    assert "PartitionFilters: [isnotnull(p" in scan._jdf.queryExecution().executedPlan().toString()


def test_snapshot_and_restore(spark, store):
    store.begin().add(starwars_quads(spark)).commit()
    to = scratch(spark)
    store.snapshot(to)
    with pytest.raises(Exception):
        store.snapshot(to)
    other = restore(spark, to, scratch(spark))
    assert other.size().first()["n"] == 90
    other.begin().clear().commit()
    with pytest.raises(ValueError):
        restore(spark, to, other.root)
    assert restore(spark, to, other.root, force=True).size().first()["n"] == 90
    with pytest.raises(ValueError):
        GraphStore.create(spark, other.root)


def test_predicates_go_to_buckets(spark):
    path = scratch(spark)
    df = quads(spark, [(f"urn:s{i}", f"urn:p{i % 50}", Lit(str(i))) for i in range(200)])
    write_quads(df, path)
    g = stored_graph(spark, path)
    assert isinstance(g, BucketedGraph) and g.quads().count() == 200
    found = bgp(g, [Pattern("?s", "urn:p7", "?o")])
    assert found.count() == 4
    assert "PartitionFilters: [isnotnull(p_bucket" in found._jdf.queryExecution().executedPlan().toString()


def test_a_bucket_filter_reaches_base_and_deltas(spark, store):
    store.begin().add(quads(spark, [(f"urn:s{i}", f"urn:p{i % 50}", Lit(str(i))) for i in range(200)])).commit()
    store.compact()
    store.begin().add(quads(spark, [("urn:new", "urn:p7", Lit("x")), ("urn:new", "urn:p8", Lit("x"))])).commit()
    plan = bgp(store.graph(), [Pattern("?s", "urn:p7", "?o")])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("PartitionFilters: [isnotnull(p_bucket") + plan.count("PartitionFilters: [isnotnull(op") >= 2
    store.begin().remove(quads(spark, [("urn:s7", "urn:p7", Lit("7"))])).commit()
    found = bgp(store.graph(), [Pattern("?s", "urn:p7", "?o")])
    assert found.count() == 4 and rows(found, "s")[0] == ("urn:new",)
    scans = [x for x in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]]
    assert scans and all("p_bucket" in x.split("]")[0] for x in scans)


def test_re_added_quads_and_clean_up(spark, store):
    one = quads(spark, ONE)
    for step in ("add", "remove", "add", "remove", "add"):
        getattr(store.begin(), step)(one).commit()
    store.compact()
    assert store.begin().remove(one).commit() == {"added": 0, "removed": 1}
    assert store.begin().add(one).commit() == {"added": 1, "removed": 0}
    assert store.quads().count() == 1 and store.size_estimate().first()["n"] == 1
    store.clean()
    assert store.quads().count() == 1
    from pathlib import Path

    kept = sorted(p.name.split("-")[0] for p in Path(store.root.removeprefix("file:")).iterdir() if not p.name.startswith("."))
    assert kept == ["base", "delta", "delta", "versions"]


def test_only_one_of_two_commits_wins(spark, store):
    one, two = store.begin().add(quads(spark, ONE)), store.begin().add(quads(spark, [("urn:x", "urn:y", "urn:z")]))
    one.commit()
    with pytest.raises(RuntimeError):
        two.commit()
    assert rows(store.quads(), "s") == [("urn:subj",)]


def test_prefixes_travel_with_snapshots(spark, store):
    store.set_prefixes(spark.createDataFrame([("a", "urn:a#")], "prefix string, iri string"))
    store.begin().add(quads(spark, ONE)).commit()
    to = scratch(spark)
    store.snapshot(to)
    copy = restore(spark, to, scratch(spark))
    assert rows(copy.prefixes(), "prefix", "iri") == [("a", "urn:a#")] and copy.quads().count() == 1


def test_caches_open_again(spark):
    folder, seen = scratch(spark), []

    def make():
        seen.append(1)
        return spark.range(len(seen)).withColumn("x", F.lit("y"))

    cached_query(spark, "n", folder, make)
    again = Cache(spark, "n", folder)
    assert again.read().count() == 1 and again.version() == 1
    again.refresh(lambda df: df.union(df))
    assert cached_query(spark, "n", folder, make).read().count() == 2 and len(seen) == 1
    with pytest.raises(ValueError):
        again.refresh()


def test_bulk_load_counts(spark):
    a = quads(spark, [("urn:s", "urn:p", "urn:o"), *[("_:x", f"urn:p{i}", Lit("v")) for i in range(5)]])
    df = bulk_quads((a, DEFAULT_GRAPH), (quads(spark, ONE), "urn:context"), (quads(spark, ONE), "urn:context"))
    assert {r["g"]: r["count"] for r in df.groupBy("g").count().collect()} == {DEFAULT_GRAPH: 6, "urn:context": 1}


triple = st.tuples(st.sampled_from(["urn:a", "urn:b"]), st.sampled_from(["urn:p", "urn:q"]), st.sampled_from(["urn:x", Lit("1"), Lit("1", lang="en")]))
step = st.tuples(st.booleans(), st.lists(triple, min_size=1, max_size=4))


@settings(max_examples=4, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(step, min_size=1, max_size=3), min_size=1, max_size=2))
def test_batches_behave_like_sets(spark, batches):
    store, model = GraphStore.create(spark, scratch(spark)), set()
    for steps in batches:
        batch, after = store.begin(), set(model)
        for adds, data in steps:
            (batch.add if adds else batch.remove)(quads(spark, data))
            after = after | set(data) if adds else after - set(data)
        assert batch.commit() == {"added": len(after - model), "removed": len(model - after)}
        model = after
    want = sorted(tuple(r) for r in quads(spark, list(model)).collect()) if model else []
    assert sorted(tuple(r) for r in store.quads().collect()) == want


def test_documents(spark):
    empty = documents(spark.createDataFrame([], "n string, c string"), "n", "c")
    assert size(empty).first()["n"] == 0
    doc = documents(spark.createDataFrame([("doc", "some text"), ("two", "ü")], "n string, c string"), "n", "c")
    names = spark.createDataFrame([("doc",), ("none",)], "name string")
    store = upsert(empty, doc)
    assert size(store).first()["n"] == 2
    assert lookup(store, names).collect()[0]["content"] == b"some text"
    assert rows(store, "name", "length") == [("doc", 9), ("two", 2)]
    store = upsert(store, documents(spark.createDataFrame([("doc", "new")], "n string, c string"), "n", "c"))
    assert rows(store, "name", "length") == [("doc", 3), ("two", 2)]
    assert rows(delete(store, names), "name") == [("two",)]
    assert size(delete(store)).first()["n"] == 0


def test_caches(spark, store):
    store.begin().add(two_graphs(spark)).commit()

    class Live:
        def quads(self):
            return store.quads()

    cache = cached_graph(spark, "cache://one", scratch(spark), Live(), G1)
    assert cache.read().count() == 2
    store.begin().add(quads(spark, ONE), G1).commit()
    assert cache.read().count() == 2
    cache.refresh()
    assert cache.read().count() == 3
    cache.refresh(lambda old: old.filter(F.col("s") != "urn:subj"))
    assert cache.read().count() == 2
    lazy = cached_query(spark, "cache://two", scratch(spark), lambda: bgp(store.graph(), SPO, Dataset.of(default=[G1])), register_only=True)
    assert lazy.read().count() == 3
    store.begin().clear().commit()
    assert lazy.read().count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def star_data(spark):
    rows_ = [(f"urn:s{i}", "urn:name", Lit(f"n{i}")) for i in range(50)] + [(f"urn:s{i}", "urn:age", Lit(str(i), XSD_INTEGER)) for i in range(0, 50, 2)]
    rows_ += [(f"urn:s{i}", "urn:knows", f"urn:s{(i * 7) % 50}") for i in range(50)] + [(f"urn:s{i}", "urn:tag", Lit(t)) for i in range(5) for t in "ab"]
    rows_ += [(f"urn:s{i}", "urn:likes", f"urn:s{(i * 7) % 50}") for i in range(0, 50, 4)]
    rows_ += [(f"urn:s{i}", "urn:age", Lit(str(i + 1), XSD_INTEGER), G1) for i in range(3)] + [("urn:s1", "urn:name", Lit("other"), G1)]
    return quads(spark, rows_)


STARS = [
    [Pattern("?s", "urn:name", "?n"), Pattern("?s", "urn:age", Val("?a", "long"))],
    [Pattern("?s", "urn:name", Val("?n", "string")), Pattern("?s", "urn:age", Lit("8", XSD_INTEGER)), Pattern("?s", "urn:knows", "?k")],
    [Pattern("urn:s4", "urn:likes", "?k"), Pattern("urn:s4", "urn:knows", "?k")],
    [Pattern("?s", "urn:name", "?n"), Pattern("?s", "urn:knows", "?s")],
    [Pattern("?s", "urn:name", "?n"), Pattern("?s", "urn:age", "?a"), Pattern("?s", "urn:tag", "?t")],
    [Pattern("?s", "urn:name", "?n", "?g"), Pattern("?s", "urn:age", "?a", "?g")],
    [Pattern("?s", "urn:name", "?n"), Pattern("?s", "urn:knows", "?k"), Pattern("?k", "urn:name", "?m"), Pattern("?k", "urn:age", "?b")],
    [Pattern("?s", "urn:name", "?n"), Pattern("?s", "urn:none", "?k")],
]


def same_answers(store, plain):
    for patterns in STARS:
        found, want = bgp(store.graph(), patterns), bgp(plain, patterns)
        assert sorted(map(repr, found.select(*sorted(found.columns)).collect())) == sorted(map(repr, want.select(*sorted(want.columns)).collect())), patterns


def test_a_star_over_stored_quads_is_one_scan(spark, store):
    store.begin().add(star_data(spark)).commit()
    store.cluster()
    for patterns in STARS[:4]:
        plan = plan_of(bgp(store.graph(), patterns))
        assert "Exchange" not in plan and "Join" not in plan and plan.count("FileScan") == 1, plan
    same_answers(store, StoredGraph(store.quads()))
    joined = plan_of(bgp(store.graph(), STARS[4]))
    assert "Join" in joined  # two tags of one subject: that pattern is joined
    read = re.search(r"FileScan parquet \[(.*?)\]", plan_of(bgp(store.graph(), STARS[0]))).group(1)
    assert len(re.findall(r"\bm\d+#", read)) == 2  # the maps of two predicates of 32


def test_stars_stay_right_over_commits(spark, store):
    store.begin().add(star_data(spark)).commit()
    store.cluster()
    store.begin().add(quads(spark, [("urn:s3", "urn:name", Lit("second")), ("urn:new", "urn:name", Lit("x")), ("urn:new", "urn:age", Lit("8", XSD_INTEGER))])).remove(
        quads(spark, [("urn:s4", "urn:name", Lit("n4"))])).commit()
    same_answers(store, StoredGraph(store.quads()))
    store.begin().clear(G1).commit()
    same_answers(store, StoredGraph(store.quads()))
    store.compact()
    assert store._record()["deltas"] == [] and store._record()["stars"]["pending"] == []
    same_answers(store, StoredGraph(store.quads()))
    store.clean()
    same_answers(store, StoredGraph(store.quads()))
    store.begin().clear().add(quads(spark, [("urn:s1", "urn:name", Lit("again"))])).commit()
    same_answers(store, StoredGraph(store.quads()))


def delta_rows(store):
    name = store.current()[2][-1]["name"]
    return store.spark.read.parquet(f"{store.root}/{name}").count()


def test_emptying_a_graph_writes_no_quad(spark, store):
    data = quads(spark, [(f"urn:s{i}", f"urn:p{i % 3}", Lit(str(i)), G1 if i % 2 else G2) for i in range(40)])
    store.begin().add(data).commit()
    assert store.begin().clear(G1).commit() == {"added": 0, "removed": 20} and delta_rows(store) == 0
    assert "Join" not in plan_of(store.quads()) and n(store, G1) == 0 and n(store, G2) == 20
    assert store.size().first()["n"] == store.size_estimate().first()["n"] == 20
    # What was there and is there again is no change, but has to be held.
    kept = quads(spark, [("urn:s2", "urn:p2", Lit("2"), G2), ("urn:new", "urn:p", Lit("1"), G2), ("urn:new", "urn:p", Lit("1"), G1)])
    batch = store.begin().add(quads(spark, [("urn:gone", "urn:p", Lit("1"), G2)])).clear(G2).add(kept)
    assert rows(batch.quads(), *QUAD) == rows(kept, *QUAD)
    assert batch.commit() == {"added": 2, "removed": 19}
    assert rows(store.quads(), *QUAD) == rows(kept, *QUAD) and delta_rows(store) == 3
    assert store.size_estimate().first()["n"] == 3
    assert store.begin().clear(G2).remove(kept).commit() == {"added": 0, "removed": 3}
    assert store.begin().clear("urn:absent").commit() == {"added": 0, "removed": 0}
    assert store.begin().add(kept).clear().commit() == {"added": 0, "removed": 0} and store.size().first()["n"] == 0
    store.begin().add(kept).commit()
    store.compact()
    assert rows(store.quads(), *QUAD) == rows(kept, *QUAD)


def test_a_document_store_over_two_sessions(spark):
    root = scratch(spark)
    store = DocumentStore(spark, root)

    def docs(*pairs):
        return documents(spark.createDataFrame(list(pairs), "n string, c string"), "n", "c")

    def names(*some):
        return spark.createDataFrame([(x,) for x in some], "name string")

    assert store.size().first()["n"] == 0 and store.get(["doc"]).count() == 0
    store.put(docs(*[(f"d{i}", f"text {i}") for i in range(50)], ("doc", "some text"), ("two", "ü"), (None, "x")))
    other = DocumentStore(spark.newSession(), root)
    assert other.size().first()["n"] == 52 and other.get(["doc"]).collect()[0]["content"] == b"some text"
    before = {f for log in store._current()[1] for f in spark.read.parquet(f"{root}/{log}").inputFiles()}
    other.put(docs(("doc", "new"), ("doc", "newer"), ("three", "3")))
    other.delete(names("two", "absent", None))
    logs = store._current()[1]
    assert len(logs) == 3 and {f for f in spark.read.parquet(f"{root}/{logs[0]}").inputFiles()} == before
    assert spark.read.parquet(f"{root}/{logs[1]}").count() == 2 and spark.read.parquet(f"{root}/{logs[2]}").count() == 2
    assert store.size().first()["n"] == 52 and rows(store.get(names("doc", "two", "three", "none")), "name", "length") == [("doc", 5), ("three", 1)]
    one = plan_of(store.get(["doc"]))
    assert "n_bucket" in one.split("PartitionFilters: [")[1].split("]")[0]
    assert "dynamicpruning" in plan_of(store.get(names("doc"))).lower()
    assert "content" not in plan_of(store.size())
    store.put(docs(("two", "back")))
    want = rows(store.read(), "name", "length")
    store.compact()
    assert len(store._current()[1]) == 2 and rows(store.read(), "name", "length") == want
    store.compact(keep_first=False)
    store.clean()
    assert len(store._current()[1]) == 1 and rows(other.read(), "name", "length") == want and len(want) == 53
    other.clear()
    assert store.size().first()["n"] == 0
    store.put(docs(("doc", "z")))
    assert rows(other.read(), "name", "length") == [("doc", 1)]


def test_upkeep_rewrites_the_buckets_that_have_changed(spark, store, monkeypatch):
    from quadrille.operators import store as module

    base = quads(spark, [(f"urn:s{i}", f"urn:p{i % 20}", Lit(str(i))) for i in range(400)])
    store.begin().add(base).commit()
    store.compact()
    store.cluster()
    main = store._record()["base"]
    monkeypatch.setattr(module, "MOST_DELTAS", 4)
    model = {tuple(r) for r in base.collect()}
    rng = random.Random(6)
    most = 0
    for k in range(9):
        new = quads(spark, [(f"urn:new{k}-{i}", "urn:p7", Lit("x")) for i in range(6)] + [(f"urn:s{k}", "urn:p3", Lit("y"))])
        old = quads(spark, [tuple([r[0], r[1], Lit(r[2])]) for r in rng.sample(sorted(model), 2)])
        batch = store.begin().remove(old)
        if k == 5:
            batch.clear().add(base)
            model = {tuple(r) for r in base.collect()}
        batch.add(new).commit()
        model -= {tuple(r) for r in old.collect()} if k != 5 else set()
        model |= {tuple(r) for r in new.collect()}
        most = max(most, len(store.current()[2]))
        assert {tuple(r) for r in store.quads().collect()} == model
    record = store._record()
    assert most <= 4 and record["base"] == main
    seven = module.predicate_bucket
    bucket = spark.range(1).select(seven(F.lit("urn:p7")).alias("b")).first()["b"]
    assert bucket in {b for f in record["folds"] for b in f["buckets"]}
    same_answers_of = [Pattern("?s", "urn:p7", "?o"), Pattern("?s", "urn:p3", "?q")]
    assert rows(bgp(store.graph(), same_answers_of), "s") == rows(bgp(StoredGraph(store.quads()), same_answers_of), "s")
    assert store.size().first()["n"] == store.size_estimate().first()["n"] == len(model)
    store.clean()
    assert {tuple(r) for r in store.quads().collect()} == model


def test_one_changed_predicate_is_one_folded_bucket(spark, store):
    store.begin().add(quads(spark, [(f"urn:s{i}", f"urn:p{i % 20}", Lit(str(i))) for i in range(200)])).commit()
    store.compact()
    store.begin().add(quads(spark, [(f"urn:t{i}", "urn:p7", Lit(str(i))) for i in range(9)])).commit()
    want = rows(store.quads(), *QUAD)
    assert len(store.upkeep()) == 1 and rows(store.quads(), *QUAD) == want
    folder = store._record()["folds"][0]["name"]
    assert spark.read.parquet(f"{store.root}/{folder}").select("p").distinct().count() == 1
    store.begin().add(quads(spark, [("urn:one", "urn:p8", Lit("1"))])).commit()
    assert store.upkeep() == [] and store.size().first()["n"] == 210


def test_estimates_from_sketches(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(
        F.concat(F.lit("urn:order"), "l_orderkey").alias("s"), F.lit("urn:part").alias("p"), F.concat(F.lit("urn:part"), "l_partkey").alias("o_value"), F.lit("uri").alias("o_type"),
        F.lit("").alias("o_datatype"), F.lit("").alias("o_lang"), F.lit(DEFAULT_GRAPH).alias("g")).distinct()
    store = GraphStore.create(spark, scratch(spark), lines.filter("s < 'urn:order5'"), is_set=True)
    with pytest.raises(ValueError):
        store.estimates()
    store.analyze()
    store.begin().add(lines).add(quads(spark, ONE)).commit()
    for _ in range(2):
        got = {r["p"]: r for r in store.estimates().collect()}
        want = lines.agg(F.countDistinct("s").alias("subjects"), F.countDistinct("o_value").alias("objects"), F.count("*").alias("quads")).first()
        assert got["urn:part"]["quads"] == want["quads"] and got["urn:pred"]["subjects"] == 1
        for c in ("subjects", "objects"):
            assert abs(got["urn:part"][c] - want[c]) <= 0.03 * want[c]
        assert "base-" not in plan_of(store.estimates()) and "delta-" not in plan_of(store.estimates())
        store.compact()


def test_cached_matches_follow_the_changes(spark, store):
    rng = random.Random(9)

    def some(k):
        return [(f"urn:n{rng.randrange(12)}", f"urn:{rng.choice('pq')}", rng.choice([f"urn:n{rng.randrange(12)}", Lit(str(rng.randrange(3)))])) for _ in range(k)]

    store.begin().add(quads(spark, some(60))).commit()
    store.compact()
    queries = {
        "one": [Pattern("?a", "urn:p", "?b")], "join": [Pattern("?a", "urn:p", "?b"), Pattern("?b", "urn:q", "?c")], "same": [Pattern("?a", "urn:p", "?b"), Pattern("?b", "urn:p", "?a")],
    }
    caches = {name: CachedMatch(spark, scratch(spark, name), store, patterns) for name, patterns in queries.items()}
    assert not [f for f in caches["one"]._changed(caches["one"]._current()).inputFiles() if "/base-" in f]
    for step in range(3):
        gone = [tuple([r[0], r[1], Lit(r[2]) if r[3] == "literal" else r[2]]) for r in rng.sample(sorted(map(tuple, store.quads().collect())), 8)]
        store.begin().remove(quads(spark, gone)).add(quads(spark, some(10) + gone[:3])).commit()
        if step == 1:  # two commits before the next refresh
            store.begin().add(quads(spark, gone)).commit()
        one = caches["one"]
        assert not [f for f in one._changed(one._current()).inputFiles() if "/base-" in f]
        for name, cache in caches.items():
            assert cache.refresh() is True
            want = bgp(store.graph(), queries[name])
            assert sorted(map(repr, cache.read().collect())) == sorted(map(repr, want.select(*cache.columns).collect())), (step, name)
    store.begin().clear().add(quads(spark, some(5))).commit()
    assert caches["one"].refresh() is False
    store.compact()
    assert caches["one"].refresh() is False and caches["one"].refresh() is True
    assert sorted(map(repr, caches["one"].read().collect())) == sorted(map(repr, bgp(store.graph(), queries["one"]).select("a", "b").collect()))


def test_large_batches_meet_the_store_in_one_aggregation(spark, monkeypatch, capsys):
    from quadrille.operators import store as module

    rng, terms = random.Random(5), [(f"urn:s{i}", f"urn:p{j}", Lit(str(k))) for i in range(4) for j in range(3) for k in range(2)]
    for i in range(3):
        states = []
        base, one, two = (quads(spark, rng.sample(terms, 9)).unionByName(quads(spark, rng.sample(terms, 5), "urn:g")) for _ in range(3))
        for most in (module.BROADCAST_BYTES, 0):
            with monkeypatch.context() as m:
                m.setattr(module, "BROADCAST_BYTES", most)
                kept = GraphStore.create(spark, scratch(spark, "store"), base)
                batch = kept.begin()
                batch = (batch.clear("urn:g") if i else batch).add(one).add(one).remove(two)
                batch.changes().explain()
                assert ("Join" in capsys.readouterr().out) == bool(most)
                states.append((batch.commit(), rows(kept.quads(), *QUAD)))
        assert states[0] == states[1]


def wide(spark, n=2000):
    """Quads of some subjects with few and one with very many values, of several predicates."""
    s, p = "CASE WHEN id % 3 = 0 THEN 'urn:hub' ELSE concat('urn:s', id % 500) END", "concat('urn:p', id % 4)"
    return spark.range(n).selectExpr(f"{s} AS s", f"{p} AS p", "cast(id AS string) AS o_value", "'literal' AS o_type", "'' AS o_datatype", "'' AS o_lang", f"'{DEFAULT_GRAPH}' AS g")


@pytest.mark.parametrize("file_rows", [0, 10_000])
def test_a_large_commit_deals_out_the_quads_of_a_large_subject(spark, monkeypatch, file_rows):
    from quadrille.operators import store as module

    for name, value in (("BROADCAST_BYTES", 0), ("TASK_ROWS", 50), ("FILE_ROWS", file_rows)):
        monkeypatch.setattr(module, name, value)
    data = wide(spark)
    store = GraphStore.create(spark, scratch(spark, "store"), data.filter("o_value < '5'"))
    batch = store.begin().remove(data.filter("o_value > '8'")).add(data.filter("o_value <= '7'")).remove(data.filter("o_value < '2'"))
    changes = batch._changes()[0]
    largest = changes.withColumn("task", F.spark_partition_id()).filter("s = 'urn:hub'").groupBy("task").count().agg(F.max("count")).first()[0]
    values = [str(i) for i in range(2000)]
    added, removed = [v for v in values if "5" <= v <= "7"], [v for v in values if v < "2"]
    assert largest < 50
    assert batch.commit() == {"added": len(added), "removed": len(removed)}
    assert sorted(r["o_value"] for r in store.quads().collect()) == sorted(v for v in values if "2" <= v <= "7")


def test_a_commit_keeps_no_staged_table(spark, monkeypatch, tmp_path):
    from quadrille import session
    from quadrille.operators import store as module

    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: str(tmp_path))
    for most in (0, module.BROADCAST_BYTES):
        monkeypatch.setattr(module, "BROADCAST_BYTES", most)
        store = GraphStore.create(spark, str(tmp_path / f"store-{most}"), wide(spark, 20))
        assert store.begin().add(wide(spark, 30)).commit() == {"added": 10, "removed": 0}
        assert store.size().first()["n"] == 30 and not [f.name for f in tmp_path.iterdir() if f.name.split("-")[0] in ("staged", "cut")]


def test_shuffles_of_a_write_are_deleted_with_its_end(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {name for name in disk.getAllBlocks().mkString("\n").split("\n") if name.startswith("shuffle_")}

    old = shuffles()
    counted = cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while shuffles() - old and time.time() < until:
        time.sleep(0.2)
    assert shuffles() <= old and counted.count() == 7


def test_fingerprints_tell_texts_apart_where_they_meet(spark):
    from quadrille.operators.store import fingerprint

    rows_ = [("a\nb", "c", "d"), ("a", "b\nc", "d"), ("a", "b", "c\nd"), ("a", "b", None), ("a", "b", "")]
    df = spark.createDataFrame([(s, p, o, "literal", "", "", "urn:g") for s, p, o in rows_], "s string, p string, o_value string, o_type string, o_datatype string, o_lang string, g string")
    found = [bytes(r[0]) for r in df.select(fingerprint()).collect()]
    assert len(set(found)) == 5 and {len(f) for f in found} == {16}
