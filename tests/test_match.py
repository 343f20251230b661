import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixtures import SW
from quadrille.functions.terms import lexical, number
from quadrille.model import RDF_TYPE, RDFS_SUBCLASS, XSD_INTEGER, Lit, Val, quads
from quadrille.operators.graph import Dataset, Pattern, StoredGraph, UnionGraph
from quadrille.operators.patterns import (
    ask, bgp, bind_params, construct, exists, join, join_compatible, join_values, list_graphs, minus, not_exists, optional, page, topk, union, values,
)


@pytest.fixture(scope="module")
def graph(starwars):
    return StoredGraph(starwars)


def test_ninety_triples(starwars):
    assert starwars.count() == starwars.distinct().count() == 90


def test_constant_literal(graph):
    assert bgp(graph, [Pattern("?s", SW + "name", Lit("Luke Skywalker"))]).count() == 1
    assert bgp(graph, [Pattern("?s", SW + "id", Lit("1000", XSD_INTEGER))]).count() == 1
    assert bgp(graph, [Pattern("?s", SW + "id", Lit("1000"))]).count() == 0


def test_offset_and_limit(graph):
    humans = bgp(graph, [Pattern("?s", RDF_TYPE, SW + "Human")])
    assert humans.count() == 5
    assert page(humans, ["s"], limit=10, offset=1).count() == 4


def test_bindings(graph):
    patterns = bind_params([Pattern("?s", SW + "name", "?o")], {"o": Lit("Luke Skywalker")})
    found = bgp(graph, patterns)
    assert found.columns == ["s"] and found.count() == 1


def test_star_and_path(graph):
    found = bgp(graph, [
        Pattern("?s", RDF_TYPE, SW + "Human"), Pattern("?s", SW + "homePlanet", "?p"), Pattern("?p", SW + "system", "?y"),
    ])
    got = rows(found.select("s", "p", lexical(F.col("y")).alias("y")), "s", "p", "y")
    assert got == sorted([
        (SW + "luke", SW + "Tatooine", SW + "Tatoo"), (SW + "vader", SW + "Tatooine", SW + "Tatoo"), (SW + "leia", SW + "Alderaan", SW + "Alderaan"),
    ])


def test_literal_never_joins_a_node(spark):
    g = StoredGraph(quads(spark, [("urn:a", "urn:p", Lit("urn:b")), ("urn:a", "urn:p", "urn:b"), ("urn:b", "urn:q", "urn:c")]))
    assert bgp(g, [Pattern("?x", "urn:p", "?y"), Pattern("?y", "urn:q", "?z")]).count() == 1
    left = bgp(g, [Pattern("?x", "urn:p", "?y")])
    assert left.count() == 2
    assert join(left, bgp(g, [Pattern("?y", "urn:q", "?z")])).count() == 1


def test_terms_join_by_all_their_parts(spark):
    g = StoredGraph(quads(spark, [
        ("urn:a", "urn:p", Lit("x")), ("urn:b", "urn:q", Lit("x", lang="en")), ("urn:c", "urn:q", Lit("x")), ("urn:d", "urn:q", Lit("x", "urn:t")),
    ]))
    found = bgp(g, [Pattern("?a", "urn:p", "?v"), Pattern("?b", "urn:q", "?v")])
    assert rows(found, "a", "b") == [("urn:a", "urn:c")]


def test_repeated_variable(spark):
    g = StoredGraph(quads(spark, [("urn:a", "urn:p", "urn:a"), ("urn:a", "urn:p", "urn:b"), ("urn:c", "urn:p", Lit("urn:c"))]))
    assert rows(bgp(g, [Pattern("?x", "urn:p", "?x")]), "x") == [("urn:a",)]


def test_unconnected_patterns_are_refused(graph):
    with pytest.raises(ValueError):
        bgp(graph, [Pattern("?a", SW + "name", "?n"), Pattern("?b", SW + "id", "?m")])


def test_type_error_removes_the_row(spark):
    g = StoredGraph(quads(spark, [
        ("urn:a", "urn:age", Lit("31", XSD_INTEGER)), ("urn:b", "urn:age", Lit("old", XSD_INTEGER)), ("urn:c", "urn:age", Lit("40")),
        ("urn:d", "urn:age", Lit("29", XSD_INTEGER)), ("urn:e", "urn:age", "urn:x"),
    ]))
    assert rows(bgp(g, [Pattern("?s", "urn:age", Val("?n"))]).filter("n > 30"), "s") == [("urn:a",)]
    assert rows(bgp(g, [Pattern("?s", "urn:age", "?n")]).filter(number(F.col("n")) > 30), "s") == [("urn:a",)]


GRAPHS = [("ex:a", "ex:b", "ex:c", "http://graph1"), ("ex:d", "ex:e", "ex:f", "http://graph1"), ("ex:g", "ex:h", "ex:i", "http://graph2")]
SPO = [Pattern("?s", "?p", "?o")]
GSPO = [Pattern("?s", "?p", "?o", "?g")]


@pytest.fixture(scope="module")
def two(spark):
    return StoredGraph(quads(spark, GRAPHS))


@pytest.mark.parametrize("names,n", [(["http://graph1"], 2), (["http://graph2"], 1), (["http://graph1", "http://graph2"], 3)])
def test_datasets(two, names, n):
    assert bgp(two, SPO, Dataset.of(default=names)).count() == n
    assert bgp(two, GSPO, Dataset.of(named=names)).count() == n
    assert bgp(two, SPO, Dataset.of(named=names)).count() == 0
    assert bgp(two, GSPO, Dataset.of(default=names)).count() == 0


def test_default_graphs_merge_as_a_set(spark):
    g = StoredGraph(quads(spark, [*GRAPHS, ("ex:a", "ex:b", "ex:c", "http://graph2")]))
    both = ["http://graph1", "http://graph2"]
    assert bgp(g, SPO, Dataset.of(default=both)).count() == 3
    assert bgp(g, GSPO, Dataset.of(named=both)).count() == 4
    assert bgp(g, SPO).count() == 0 and bgp(g, GSPO).count() == 4
    assert rows(list_graphs(g), "g") == [("http://graph1",), ("http://graph2",)]
    assert bgp(g, [Pattern("?s", "?p", "?o", "http://graph2")]).count() == 2
    # graph variables join
    assert bgp(g, [Pattern("?s", "ex:b", "?o", "?g"), Pattern("ex:g", "ex:h", "?x", "?g")]).count() == 1


def test_union_graph_is_a_set(spark, two):
    g = UnionGraph(two, StoredGraph(quads(spark, [GRAPHS[0], ("ex:z", "ex:b", "ex:c", "http://graph1")])))
    assert bgp(g, GSPO).count() == 4 and g.quads().count() == 4
    found = bgp(g, [Pattern("?s", "ex:b", "?o", "?g"), Pattern("?t", "?q", "?o", "?g")])
    assert found.count() == 4


def test_ask(graph):
    assert ask(bgp(graph, [Pattern(SW + "luke", RDF_TYPE, SW + "Droid")])).first()["answer"] is False
    assert ask(bgp(graph, [Pattern(SW + "luke", RDF_TYPE, SW + "Human")])).first()["answer"] is True


def test_construct(graph):
    made = construct(bgp(graph, [Pattern(SW + "luke", RDF_TYPE, "?o")]), [Pattern(SW + "luke", RDF_TYPE, "?o")])
    assert rows(made, "s", "p", "o_value") == [(SW + "luke", RDF_TYPE, SW + "Human")]
    names = bgp(graph, [Pattern("?s", SW + "name", "?n"), Pattern("?s", SW + "id", Val("?i", "long"))])
    made = construct(names, [Pattern("?s", "urn:label", "?n"), Pattern("?n", "urn:of", "?s"), Pattern("?s", "urn:nr", "?i")])
    assert made.count() == 16  # a literal cannot be a subject
    assert made.filter("p = 'urn:nr'").select("o_datatype").distinct().collect()[0][0] == XSD_INTEGER


def test_optional_exists_minus(graph):
    humans = bgp(graph, [Pattern("?s", RDF_TYPE, SW + "Human")])
    homes = bgp(graph, [Pattern("?s", SW + "homePlanet", "?h")])
    assert optional(humans, homes).count() == 5
    assert optional(humans, homes).filter("h is null").count() == 2
    assert exists(humans, homes).count() == 3
    assert not_exists(humans, homes).count() == 2
    assert minus(humans, homes).count() == 2
    other = bgp(graph, [Pattern("?z", SW + "homePlanet", "?h")])
    assert minus(humans, other).count() == 5
    assert not_exists(humans, other).count() == 0
    assert exists(humans, other).count() == 5


def test_unbound_joins_everything(spark):
    left = values(spark, ["x", "v"], [("urn:a", "urn:1"), ("urn:b", None)])
    right = values(spark, ["x", "v", "w"], [("urn:a", "urn:1", "urn:w1"), ("urn:a", "urn:2", "urn:w2"), ("urn:b", "urn:2", "urn:w3")])
    assert rows(join_compatible(left, right, "v"), "x", "v", "w") == [("urn:a", "urn:1", "urn:w1"), ("urn:b", "urn:2", "urn:w3")]


def test_union_and_values(graph, spark):
    humans = bgp(graph, [Pattern("?s", RDF_TYPE, SW + "Human")])
    planets = bgp(graph, [Pattern("?s", RDF_TYPE, SW + "Planet"), Pattern("?s", SW + "system", "?y")])
    both = union(humans, planets)
    assert both.count() == 7 and both.filter("y is null").count() == 5
    inline = values(spark, ["s"], [(SW + "luke",), (SW + "nobody",)])
    assert join_values(humans, inline).count() == 1
    names = bgp(graph, [Pattern("?s", SW + "name", "?n")])
    assert join_values(names, values(spark, ["n"], [(Lit("C-3PO"),), (Lit("R2-D2"),)])).count() == 2


def test_unicode_is_kept(spark, graph):
    g = StoredGraph(quads(spark, [(SW + "βüãäoñr̈", RDF_TYPE, SW + "Employee")]))
    assert bgp(g, SPO).first()["s"] == SW + "βüãäoñr̈"
    assert bgp(graph, [Pattern("?s", SW + "name", Lit("Rick βüãäoñr"))]).count() == 1


def test_schema_rows(graph):
    assert bgp(graph, [Pattern("?c", RDFS_SUBCLASS, SW + "Character")]).count() == 2


def test_pages_and_ties(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("tie")).repartition(5)
    for limit, offset in ((50, 100), (None, 990), (20, 995), (2000, 0), (5, 5000), (0, 3), (10, 0)):
        got = [r["k"] for r in page(df, ["k"], limit, offset).collect()]
        assert got == list(range(1000))[offset:][:limit]
    want = sorted((r["tie"], r["k"]) for r in df.collect())
    assert [(r["tie"], r["k"]) for r in page(df, ["tie"], 40, 310).collect()] == want[310:350]
    assert [(r["tie"], r["k"]) for r in topk(df, ["tie"], 40).collect()] == want[:40]


def agree(a, b, names):
    return all(a[n] is None or b[n] is None or a[n] == b[n] for n in names)


def test_unbound_variables_agree_with_any_value(spark):
    left = values(spark, ["x", "v", "n"], [("urn:a", "urn:1", 1), ("urn:b", None, 2), ("urn:z", "urn:2", 3), ("urn:c", "urn:9", 4), ("urn:b", None, 2)])
    right = values(spark, ["x", "v", "w"], [("urn:a", "urn:1", 1), ("urn:b", "urn:7", 2), ("urn:z", "urn:2", 3), ("urn:a", None, 4), ("urn:b", "urn:8", 5)])
    l, r = [x.asDict() for x in left.collect()], [x.asDict() for x in right.collect()]
    pairs = [(a, b) for a in l for b in r if agree(a, b, ("x", "v"))]
    met = sorted(((a["x"] or b["x"], a["v"] or b["v"], a["n"], b["w"]) for a, b in pairs), key=repr)
    alone = [(a["x"], a["v"], a["n"], None) for a in l if not any(agree(a, b, ("x", "v")) for b in r)]
    assert rows(join(left, right), "x", "v", "n", "w") == met
    assert rows(optional(left, right), "x", "v", "n", "w") == sorted(met + alone, key=repr)
    assert rows(exists(left, right), "n") == sorted((a["n"],) for a in l if any(agree(a, b, ("x", "v")) for b in r))
    assert rows(not_exists(left, right), "n") == sorted((a["n"],) for a in l if not any(agree(a, b, ("x", "v")) for b in r))
    assert rows(minus(left, right), "n") == rows(not_exists(left, right), "n")
    some = optional(left, right, F.col("w") > 2)
    kept = [(a, b) for a, b in pairs if b["w"] > 2]
    assert some.filter("w is not null").count() == len(kept) and some.filter("w is null").count() == sum(not any(a is x for x, _ in kept) for a in l)
    with pytest.raises(ValueError):
        optional(left.select("n"), right)
    disjoint = values(spark, ["x", "v"], [(None, None)])
    assert minus(left, disjoint.select("x", "v")).count() == 5 and exists(left, disjoint).count() == 5


def test_patterns_without_variables_are_conditions(graph):
    names = Pattern("?s", SW + "name", "?n")
    there, gone = Pattern(SW + "luke", RDF_TYPE, SW + "Human"), Pattern(SW + "luke", RDF_TYPE, SW + "Droid")
    assert bgp(graph, [names, there]).count() == bgp(graph, [names]).count() > 0
    assert bgp(graph, [there, names, gone]).count() == 0
    assert bgp(graph, bind_params([Pattern("?h", RDF_TYPE, SW + "Human"), names], {"h": SW + "luke"})).count() == bgp(graph, [names]).count()


def test_text_of_literals_is_no_node_and_blank_nodes_are_fresh(graph):
    found = bgp(graph, [Pattern("?s", RDF_TYPE, SW + "Human"), Pattern("?s", SW + "name", Val("?n", "string"))])
    made = construct(found, [Pattern("_:b", "urn:about", "?s"), Pattern("_:b", "urn:name", "?n"), Pattern("?n", "urn:x", "?s")])
    assert made.filter("p = 'urn:x'").count() == 0
    assert made.filter("p = 'urn:name'").select("o_type").distinct().collect()[0][0] == "literal"
    assert made.select("s").distinct().count() == found.count() and made.count() == 2 * found.count()


def test_rows_without_a_bound_shared_variable(spark):
    left = spark.createDataFrame([("a", "x"), (None, "y")], "k string, l string")
    right = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, r string")
    # One left row has no variable in common: it agrees with every right row.
    assert rows(join(left, right), "k", "l", "r") == [("a", "x", "1"), ("a", "y", "1"), ("b", "y", "2")]
    assert rows(optional(left, right), "k", "l", "r") == [("a", "x", "1"), ("a", "y", "1"), ("b", "y", "2")]
    assert rows(optional(left, right, F.col("r") == "2"), "k", "l", "r") == sorted([("a", "x", None), ("b", "y", "2")], key=repr)
    assert rows(optional(left, right, F.col("r") == "9"), "l", "r") == [("x", None), ("y", None)]
    empty = right.filter("k = 'none'")
    assert rows(optional(left, empty), "l", "r") == [("x", None), ("y", None)] and join(left, empty).count() == 0
    open_ = spark.createDataFrame([(None, "9")], "k string, r string")
    assert rows(optional(left, right.filter("r = '1'").unionByName(open_)), "l", "r") == [("x", "1"), ("x", "9"), ("y", "1"), ("y", "9")]
    many = spark.createDataFrame([(None, "y"), (None, "z")], "k string, l string")
    with pytest.raises(ValueError, match=r"\?k unbound"):
        join(many, right)
    with pytest.raises(ValueError, match=r"\?k unbound"):
        optional(many, right)
    assert join(many, open_).count() == 2


def test_construct_makes_solutions_of_one_large_task_distinct_in_many(spark, tmp_path):
    # One row group, which is not cut: its rows must leave the task that reads them before any aggregation holds them.
    rows_ = spark.range(60_000, numPartitions=1).select(F.concat(F.lit("urn:"), F.col("id") % 50_000).alias("s"), F.lit("v").alias("n"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    rows_.write.parquet(f"{tmp_path}/rows")
    made = construct(spark.read.parquet(f"{tmp_path}/rows"), [Pattern("?s", "urn:p", "?n")])
    plan = [line.strip(" +-:") for line in made._jdf.queryExecution().executedPlan().toString().splitlines()]
    deep = [line.split("(")[0] for line in plan if line.startswith(("Exchange", "HashAggregate"))]
    assert deep[-1].startswith("Exchange") and deep.count("HashAggregate") == 2
    assert made.count() == 50_000 and made.select("o_value").distinct().count() == 1
    # The rows are many alike, and a name like that of the number they are dealt by is no harm.
    same = construct(rows_.select(F.lit("urn:x").alias("s"), F.lit("y").alias("s_")), [Pattern("?s", "urn:p", "?s_")])
    assert [(r.s, r.o_value) for r in same.collect()] == [("urn:x", "y")]
