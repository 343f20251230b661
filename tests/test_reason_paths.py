import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixtures import SW
from quadrille.model import (
    OWL_DISJOINT, OWL_FUNCTIONAL, RDF_TYPE, RDFS_DOMAIN, RDFS_RANGE, RDFS_SUBCLASS, RDFS_SUBPROPERTY, XSD_INTEGER, Lit, quads,
)
from quadrille.operators.graph import Dataset, Pattern, StoredGraph
from quadrille.operators.hierarchy import Hierarchy
from quadrille.operators.nested import Field, group_concat, nest, select_fields, select_nested
from quadrille.operators.paths import edges_of, reachable, shortest_paths
from quadrille.operators.patterns import ask, bgp
from quadrille.operators.reasoning import (
    ReasonedGraph, contradictions, domain_range_schema, domain_range_types, explain_inference, explain_statements, infer_types, instances, is_consistent,
    subclass_closure, transitive_closure,
)
from quadrille.operators.store import GraphStore
from quadrille.session import scratch


def test_type_inference(starwars):
    g = StoredGraph(starwars)
    character = [Pattern("?s", RDF_TYPE, SW + "Character")]
    assert bgp(g, character).count() == 0
    r = ReasonedGraph(g)
    assert bgp(r, character).count() == 8
    assert bgp(r, [*character, Pattern("?s", SW + "name", "?n")]).count() == 8
    assert bgp(r, [Pattern(SW + "luke", RDF_TYPE, "?c")]).count() == 2
    assert bgp(r, [Pattern(SW + "luke", "?p", SW + "Character")]).count() == 1
    assert ask(bgp(r, [Pattern(SW + "luke", RDF_TYPE, SW + "Character")])).first()["answer"] is True
    assert ask(bgp(r, [Pattern(SW + "luke", RDF_TYPE, SW + "Droid")])).first()["answer"] is False
    assert r.quads().count() == 98


def test_schema_graphs(spark, starwars):
    moved = starwars.withColumn("g", F.when(F.col("p") == RDFS_SUBCLASS, "urn:schema").otherwise(F.col("g")))
    g = StoredGraph(moved)
    character = [Pattern("?s", RDF_TYPE, SW + "Character")]
    assert bgp(ReasonedGraph(g), character).count() == 0
    assert bgp(ReasonedGraph(g, ["urn:schema"]), character).count() == 8
    assert Dataset.of(default=["x"]).given


def test_closure_of_random_graphs(spark):
    random.seed(5)
    pairs = {(f"c{random.randrange(12)}", f"c{random.randrange(12)}") for _ in range(20)}
    want, new = set(pairs), set(pairs)
    while new:
        new = {(a, d) for a, b in want for c, d in pairs if b == c} - want
        want |= new
    df = transitive_closure(spark.createDataFrame(sorted(pairs), "sub string, super string"))
    got = rows(df, "sub", "super")
    assert got == sorted(want)
    for r in df.collect():
        assert r["chain"][0] == r["sub"] and r["chain"][-1] == r["super"]
        assert all(e in pairs for e in zip(r["chain"], r["chain"][1:]))
    again = transitive_closure(df.select("sub", "super"))
    assert rows(again, "sub", "super") == got


def test_subproperties_domains_ranges(spark):
    df = quads(spark, [
        ("urn:mother", RDFS_SUBPROPERTY, "urn:parent"), ("urn:parent", RDFS_SUBPROPERTY, "urn:kin"), ("urn:a", "urn:mother", "urn:b"),
        ("urn:a", "urn:kin", "urn:b"), ("urn:c", "urn:kin", Lit("x")), ("urn:kin", RDFS_DOMAIN, "urn:Person"), ("urn:kin", RDFS_RANGE, "urn:Being"),
    ])
    g = StoredGraph(df)
    r = ReasonedGraph(g)
    assert bgp(r, [Pattern("?s", "urn:kin", "?o")]).count() == 2
    assert bgp(r, [Pattern("?s", "urn:parent", "?o")]).count() == 1
    got = rows(domain_range_types(df, domain_range_schema(g)), "s", "cls")
    assert got == [("urn:a", "urn:Person"), ("urn:b", "urn:Being"), ("urn:c", "urn:Person")]


def test_explain(spark, starwars):
    g = StoredGraph(starwars)
    closure = subclass_closure(g)
    asked = spark.createDataFrame([(SW + "luke", SW + "Human"), (SW + "luke", SW + "Character"), (SW + "luke", SW + "Droid")], "s string, cls string")
    got = {r["cls"]: (r["status"], r["proof"]) for r in explain_inference(asked, starwars, closure).collect()}
    assert got == {SW + "Human": ("ASSERTED", [SW + "Human"]), SW + "Character": ("INFERRED", [SW + "Human", SW + "Character"])}
    assert infer_types(instances(g), closure).filter(F.col("cls") == SW + "Character").count() == 8


def test_consistency(spark):
    schema = quads(spark, [("urn:A", OWL_DISJOINT, "urn:B"), ("urn:one", RDF_TYPE, OWL_FUNCTIONAL)])
    good = quads(spark, [("urn:x", RDF_TYPE, "urn:A"), ("urn:y", RDF_TYPE, "urn:B"), ("urn:x", "urn:one", Lit("1"))])
    bad = quads(spark, [("urn:x", RDF_TYPE, "urn:B", "urn:g"), ("urn:x", RDF_TYPE, "urn:A", "urn:g"), ("urn:y", "urn:one", Lit("1")), ("urn:y", "urn:one", Lit("2"))])
    assert is_consistent(good, schema).first()["consistent"] is True
    assert is_consistent(bad, schema).first()["consistent"] is False
    assert rows(contradictions(bad, schema), "kind", "s", "first", "second") == [("disjoint", "urn:x", "urn:A", "urn:B"), ("functional", "urn:y", "1", "2")]
    assert rows(contradictions(bad, schema, "urn:g"), "kind") == [("disjoint",)]


def test_path_luke_leia(starwars):
    edges = edges_of(StoredGraph(starwars))
    got = shortest_paths(edges, SW + "luke", SW + "leia").collect()
    assert len(got) == 1 and got[0]["length"] == 1
    assert [tuple(h) for h in got[0]["hops"]] == [(SW + "luke", SW + "friends", SW + "leia")]
    assert shortest_paths(edges, SW + "luke", SW + "nobody").count() == 0


def brute_paths(edges, start, end):
    level, seen = [[]], {start}
    level = [((), start)]
    while level:
        nxt = [(hops + ((a, v, b),), b) for hops, at in level for a, v, b in edges if a == at and b not in seen]
        hits = sorted(h for h, at in nxt if at == end)
        if hits:
            return hits
        seen |= {at for _, at in nxt}
        level = nxt
    return []


@pytest.mark.parametrize("seed", [1, 2])
def test_paths_against_brute_force(spark, seed):
    random.seed(seed)
    nodes = [f"n{i:02d}" for i in range(14)]
    edges = sorted({(random.choice(nodes), random.choice("pq"), random.choice(nodes)) for _ in range(34)})
    df = spark.createDataFrame(edges, "src string, via string, dst string")
    for end in nodes[1:3]:
        got = sorted(tuple(tuple(h) for h in r["hops"]) for r in shortest_paths(df, nodes[0], end).collect())
        assert got == brute_paths(edges, nodes[0], end)
    reach = {n: set() for n in nodes}
    for n in nodes:
        todo = [b for a, _, b in edges if a == n]
        while todo:
            b = todo.pop()
            if b not in reach[n]:
                reach[n].add(b)
                todo += [d for c, _, d in edges if c == b]
    want = sorted((n, m) for n in nodes for m in reach[n])
    assert rows(reachable(df, df.select(F.col("src").alias("start"))), "start", "node") == want
    some = spark.createDataFrame([(nodes[0],), ("lone",)], "start string")
    assert rows(reachable(df, some, include_start=True), "start", "node") == sorted({(nodes[0], m) for m in reach[nodes[0]] | {nodes[0]}} | {("lone", "lone")})


def test_nested_objects(starwars):
    g = StoredGraph(starwars)
    assert rows(select_fields(g, SW + "Planet", [Field("system", SW + "system")]), "system") == [("Alderaan",), ("Tatoo",)]
    from quadrille.model import XSD_INTEGER

    luke = select_fields(g, SW + "Human", [Field("name", SW + "name")], {SW + "id": Lit("1000", XSD_INTEGER)})
    assert rows(luke, "name") == [("Luke Skywalker",)]
    friends = bgp(g, [
        Pattern("?id", RDF_TYPE, SW + "Human"), Pattern("?id", SW + "id", Lit("1000", XSD_INTEGER)), Pattern("?id", SW + "name", "?n"),
        Pattern("?id", SW + "friends", "?f"), Pattern("?f", SW + "name", "?fn"),
    ]).select("id", F.col("n.value").alias("name"), F.col("fn.value").alias("friend"))
    got = nest(friends, ["id", "name"], ["friend"])
    assert rows(got, "position", "friend") == [(0, "C-3PO"), (1, "Han Solo"), (2, "Leia Organa"), (3, "R2-D2")]


def test_lists_and_texts_of_any_length(spark):
    df = spark.range(25_000).select(F.when(F.col("id") < 12_000, "hot").when(F.col("id") < 24_990, F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), (F.col("id") * 7919 % 25_000).alias("id"))
    want = {}
    for r in df.collect():
        want.setdefault(r["k"], []).append(r["id"])
    got = {}
    for r in nest(df.repartition(7), ["k"], ["id"]).collect():
        got.setdefault(r["k"], []).append((r["position"], r["id"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: list(enumerate(sorted(v))) for k, v in want.items()}
    same = spark.range(30_000).select(F.lit("hot").alias("k"), F.lit("v").alias("v"))
    assert [len(r["vs"].split(",")) for r in group_concat(same, ["k"], "v", ",", "vs").collect()] == [30_000]
    assert group_concat(same, ["k"], "v", ",", "vs", distinct=True).collect()[0]["vs"] == "v"


def test_domains_and_ranges_count_in_matches_and_contradictions(spark):
    schema = [
        ("urn:wrote", RDFS_DOMAIN, "urn:Author"), ("urn:wrote", RDFS_RANGE, "urn:Book"), ("urn:drafted", RDFS_SUBPROPERTY, "urn:wrote"),
        ("urn:Author", RDFS_SUBCLASS, "urn:Person"), ("urn:Person", OWL_DISJOINT, "urn:Thing"), ("urn:Book", RDFS_SUBCLASS, "urn:Thing"),
    ]
    data = [("urn:a", "urn:wrote", "urn:b"), ("urn:c", "urn:drafted", Lit("a text"))]
    r = ReasonedGraph(StoredGraph(quads(spark, schema + data)))
    assert rows(bgp(r, [Pattern("?s", RDF_TYPE, "urn:Person")]), "s") == [("urn:a",), ("urn:c",)]
    assert rows(bgp(r, [Pattern("?s", RDF_TYPE, "urn:Thing")]), "s") == [("urn:b",)]
    assert rows(bgp(r, [Pattern("urn:a", RDF_TYPE, "?c")]), "c") == [("urn:Author",), ("urn:Person",)]
    assert r.quads().filter((F.col("p") == RDF_TYPE)).count() == 6
    assert is_consistent(quads(spark, data), quads(spark, schema)).first()["consistent"] is True
    bad = quads(spark, [*data, ("urn:a", RDF_TYPE, "urn:Book")])
    assert rows(contradictions(bad, quads(spark, schema)), "kind", "s", "first", "second") == [("disjoint", "urn:a", "urn:Person", "urn:Thing")]


def test_a_thousand_starts_share_the_rows_of_a_node(spark, monkeypatch):
    from quadrille.operators import paths

    random.seed(7)
    nodes = [f"urn:n{i}" for i in range(1200)]
    edges = [(nodes[i], nodes[(i + 1) % 40]) for i in range(40)] + [(n, nodes[k % 40]) for k, n in enumerate(nodes[40:])]
    edges += [(nodes[5], "urn:end"), (nodes[700], "urn:end"), ("urn:lone", "urn:lone")]
    df = spark.createDataFrame([(a, "p", b) for a, b in edges], "src string, via string, dst string")
    rows_of, before = [], paths.cut_measured

    def counted(frame, name="cut", **more):
        made, seen = before(frame, name, **more)
        if name == "frontier":
            rows_of.append(made.count())
        return made, seen

    monkeypatch.setattr(paths, "cut_measured", counted)
    for parts in (3,):
        rows_of.clear()
        starts = spark.createDataFrame([(n,) for n in [*nodes[40:1040], "urn:end", "urn:absent", None]], "start string").repartition(parts)
        got = rows(reachable(df, starts), "start", "node")
        want = [(n, m) for n in nodes[40:1040] for m in [*nodes[:40], "urn:end"]]
        assert got == sorted(want)
        # From each node of the circle the next one is reached: far fewer rows than pairs of start and node.
        assert max(rows_of[1:]) <= 41 * parts
    assert rows(reachable(df, df.filter("src = 'urn:lone'").select(F.col("src").alias("start"))), "node") == [("urn:lone",)]
    short = reachable(df, spark.createDataFrame([(nodes[0],)], "start string"), max_length=3)
    assert rows(short, "node") == sorted([(n,) for n in nodes[1:4]])
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert "urn:" not in plan.split("Join")[0]


def test_the_smaller_end_is_widened(spark, monkeypatch):
    from quadrille.operators import paths

    edges = [("a", "p", f"h{i}") for i in range(5)] + [("h1", "p", f"b{i}") for i in range(2000)] + [(f"b{i}", "p", f"c{i}") for i in range(2000)]
    edges += [("b0", "q", "x"), ("b1000", "q", "x"), ("x", "p", "y"), ("y", "p", "z"), ("y", "q", "z"), ("z", "p", "a")]
    df = spark.createDataFrame(edges, "src string, via string, dst string")
    levels, before = [], paths.cut_measured

    def counted(frame, name="cut", **more):
        made, seen = before(frame, name, **more)
        if name == "level":
            levels.append(seen["n"])
        return made, seen

    monkeypatch.setattr(paths, "cut_measured", counted)
    got = sorted(tuple(tuple(h) for h in r["hops"]) for r in shortest_paths(df, "a", "z").collect())
    assert got == brute_paths(edges, "a", "z") and len(got) == 4 and {len(p) for p in got} == {5}
    assert sum(levels) <= 20  # from the start alone, a level has 2,000 nodes
    assert shortest_paths(df, "a", "z", max_length=4).count() == 0 and shortest_paths(df, "a", "z", max_length=5).count() == 4
    assert shortest_paths(df, "a", "a").count() == 0 and shortest_paths(df, "c1", "a").count() == 0 and shortest_paths(df, "a", "none").count() == 0


def test_terms_that_share_a_number_get_others(spark, monkeypatch):
    from quadrille.operators import numbers

    monkeypatch.setattr(numbers, "number", lambda text, seed: F.length(text).cast("long") if seed == 0 else F.xxhash64(F.lit(seed), text))
    df = spark.createDataFrame([("aa", "p", "b"), ("b", "p", "cc")], "src string, via string, dst string")
    assert rows(reachable(df, spark.createDataFrame([("aa",), ("dd",)], "start string")), "start", "node") == [("aa", "b"), ("aa", "cc")]


def below_of(edges):
    """Everything below every name, itself included, by walking the edges."""
    names = {n for e in edges for n in e}
    out = set()
    for n in names:
        todo, seen = [n], {n}
        while todo:
            at = todo.pop()
            for sub, sup in edges:
                if sup == at and sub not in seen:
                    seen.add(sub)
                    todo.append(sub)
        out |= {(n, b) for b in seen}
    return sorted(out)


TREES = {
    "tree": [("b", "a"), ("c", "a"), ("d", "b"), ("e", "b"), ("f", "c"), ("y", "x")],
    "several parents": [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("e", "d"), ("e", "x"), ("f", "e"), ("z", "y")],
    "cycles": [("b", "a"), ("c", "b"), ("a", "c"), ("d", "c"), ("p", "q"), ("q", "p"), ("d", "q"), ("e", "e"), ("s", "t")],
    "cycle below a tree": [("b", "a"), ("c", "b"), ("b", "c"), ("d", "c"), ("x", "d"), ("x", "y"), ("y", "x")],
}


@pytest.mark.parametrize("name", [*TREES, "random"])
def test_intervals_hold_what_lies_below(spark, name):
    if name == "random":
        random.seed(11)
        edges = sorted({(f"n{random.randrange(25)}", f"n{random.randrange(25)}") for _ in range(34)})
    else:
        edges = TREES[name]
    tree = Hierarchy(spark.createDataFrame(edges, "sub string, super string"))
    names = sorted({n for e in edges if e[0] != e[1] for n in e})
    asked = spark.createDataFrame([(n,) for n in [*names, "absent"]], "name string")
    assert rows(tree.below(asked), "name", "below") == sorted([*below_of([e for e in edges if e[0] != e[1]]), ("absent", "absent")])
    spans = tree.nodes.collect()
    assert sorted(r["name"] for r in spans) == names and len({(r["tree"], r["first"]) for r in spans}) == len(spans)
    if name == "tree":
        assert tree._extras == 0


def test_sub_properties_are_one_scan(spark):
    subs = [(f"urn:p{k}", RDFS_SUBPROPERTY, f"urn:p{k // 3}") for k in range(1, 200)] + [("urn:p0", RDFS_SUBPROPERTY, "urn:p150"), ("urn:p7", RDFS_SUBPROPERTY, "urn:other")]
    data = [(f"urn:s{k}", f"urn:p{k}", f"urn:o{k % 7}") for k in range(200)] + [("urn:s1", "urn:p0", "urn:o1"), ("urn:x", "urn:q", "urn:y")]
    store = GraphStore.create(spark, scratch(spark), quads(spark, subs + data))
    r = ReasonedGraph(store.graph())
    found = bgp(r, [Pattern("?s", "urn:p0", "?o")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("base-") == 1 and rows(found, "s") == sorted([(f"urn:s{k}",) for k in range(200)])
    assert bgp(r, [Pattern("?s", "urn:p150", "?o")]).count() == 200  # on a cycle with p0
    assert bgp(r, [Pattern("?s", "urn:other", "?o")]).count() == len([k for k in range(200) if ("urn:p7", f"urn:p{k}") in set(below_of([(a, b) for a, _, b in subs]))])
    assert bgp(r, [Pattern("?s", "urn:q", "?o")]).count() == 1 and bgp(r, [Pattern("urn:x", "urn:p0", "?o")]).count() == 0


def tree_of(result, path="", parent=None):
    """The nested objects that levels stand for."""
    levels = {k: v.collect() for k, v in result.levels.items()}

    def build(path, parent):
        out = []
        for r in sorted((r for r in levels[path] if r["parent"] == parent), key=lambda r: r["position"]):
            below = [p for p in levels if p and p.rpartition("/")[0] == path]
            out.append((r["value"], {p.rpartition("/")[2]: build(p, r["row"]) for p in below if any(x["parent"] == r["row"] for x in levels[p])}))
        return out

    return build("", None)


def test_lists_below_lists(spark, starwars):
    g = StoredGraph(starwars)
    friends = Field("friends", SW + "friends", (Field("name", SW + "name"), Field("homes", SW + "homePlanet", (Field("system", SW + "system"),))))
    found = select_nested(g, SW + "Human", [Field("name", SW + "name"), friends, Field("films", SW + "appearsIn")], {SW + "id": Lit("1000", XSD_INTEGER)})
    tree = tree_of(found)
    assert len(tree) == 1 and tree[0][0] == "luke"
    fields = tree[0][1]
    assert [v for v, _ in fields["films"]] == ["Empire", "Jedi", "NewHope"] and [v for v, _ in fields["name"]] == ["Luke Skywalker"]
    assert [(v, x["name"][0][0]) for v, x in fields["friends"]] == [("artoo", "R2-D2"), ("han", "Han Solo"), ("leia", "Leia Organa"), ("threepio", "C-3PO")]
    assert dict(fields["friends"])["leia"]["homes"] == [("Alderaan", {"system": [("Alderaan", {})]})] and "homes" not in dict(fields["friends"])["han"]
    # Two lists of one entity: as many rows as elements, not as many as pairs.
    assert found.flat().filter("of = 'luke'").count() == 1 + 4 + 3
    assert rows(found.along("friends/homes/system"), "entity", "friends", "homes", "system") == [("luke", "leia", "Alderaan", "Alderaan")]
    everyone = select_nested(g, SW + "Planet", [Field("people", SW + "homePlanet", (Field("friends", SW + "friends", cls=SW + "Droid"),), inverse=True)])
    assert [(p, [(v, [f for f, _ in x.get("friends", [])]) for v, x in fields.get("people", [])]) for p, fields in tree_of(everyone)] == [
        ("Alderaan", [("leia", ["artoo", "threepio"])]), ("Tatooine", [("luke", ["artoo", "threepio"]), ("vader", [])])]
    with pytest.raises(ValueError):
        select_nested(g, None, [friends])


RULES = [
    ("urn:p1", RDFS_SUBPROPERTY, "urn:p2"), ("urn:p2", RDFS_SUBPROPERTY, "urn:p3"), ("urn:p3", RDFS_SUBPROPERTY, "urn:p1"), ("urn:p2", RDFS_SUBPROPERTY, "urn:q"),
    ("urn:q", RDFS_DOMAIN, "urn:A"), ("urn:q", RDFS_RANGE, "urn:B"), ("urn:A", RDFS_SUBCLASS, "urn:C"), ("urn:B", RDFS_SUBCLASS, "urn:C"), ("urn:C", RDFS_SUBCLASS, "urn:D"),
]


def test_every_step_of_a_proof_follows(spark):
    random.seed(3)
    data = sorted({(f"urn:n{random.randrange(8)}", f"urn:{random.choice(['p1', 'p2', 'p3', 'q', 'r'])}", f"urn:n{random.randrange(8)}") for _ in range(22)})
    data += [("urn:n1", "urn:p1", Lit("text")), ("urn:n2", RDF_TYPE, "urn:B"), ("urn:p3", "urn:q", Lit("x"))]
    stored = set(data) | set(RULES)
    held = {t: 0 for t in stored}
    after = {RDFS_SUBPROPERTY: lambda t, a, b: [(t[0], b, t[2])] if t[1] == a else [], RDFS_DOMAIN: lambda t, a, b: [(t[0], RDF_TYPE, b)] if t[1] == a else [],
             RDFS_RANGE: lambda t, a, b: [(t[2], RDF_TYPE, b)] if t[1] == a and isinstance(t[2], str) else [],
             RDFS_SUBCLASS: lambda t, a, b: [(t[0], RDF_TYPE, b)] if t[1] == RDF_TYPE and t[2] == a else []}

    def conclusions(t):
        for a, p, b in RULES:
            yield from after[p](t, a, b)
            if p in (RDFS_SUBPROPERTY, RDFS_SUBCLASS) and t[1] == p and t[2] == a:
                yield (t[0], p, b)

    height = 0
    while True:
        new = {c for t, h in held.items() if h == height for c in conclusions(t)} - set(held)
        if not new:
            break
        height += 1
        held |= dict.fromkeys(new, height)
    wrong = [("urn:n0", "urn:q", "urn:absent"), ("urn:n0", RDF_TYPE, "urn:Z"), ("urn:absent", RDF_TYPE, "urn:A")]
    asked = quads(spark, [*held, *wrong])
    found = explain_statements(asked, StoredGraph(quads(spark, data + RULES))).collect()
    got = {}
    for r in found:
        o = r["o_value"] if r["o_type"] != "literal" else Lit(r["o_value"], r["o_datatype"], r["o_lang"])
        got[(r["s"], r["p"], o)] = r
    assert set(got) == set(held) and height >= 4
    for t, r in got.items():
        assert r["status"] == ("ASSERTED" if t in stored else "INFERRED") and len(r["proof"]) == held[t]
        now = next(x for x in stored if (x[0], x[1], x[2].value if isinstance(x[2], Lit) else x[2]) == (r["from_s"], r["from_p"], r["from_o"]))
        for step in r["proof"]:
            assert (step["by_s"], step["by_p"], step["by_o"]) in RULES
            follows = {(c[0], c[1], c[2].value if isinstance(c[2], Lit) else c[2]): c for c in conclusions(now)}
            now = follows[step["s"], step["p"], step["o"]]
        assert now == t


def test_inferred_types_are_dealt_by_what_they_become(spark, monkeypatch, capsys):
    from quadrille.operators import reasoning

    types = spark.createDataFrame([(f"urn:s{i}", f"urn:c{i % 3}") for i in range(30)], "s string, cls string")
    closure = spark.createDataFrame([(f"urn:c{i}", f"urn:up{j}") for i in range(3) for j in range(4)], "sub string, super string")
    monkeypatch.setattr(reasoning, "TASK_ROWS", 40)
    found = infer_types(types, closure)
    found.explain("extended")
    assert "RepartitionByExpression [s" in capsys.readouterr().out
    assert rows(found, "s", "cls") == sorted([(f"urn:s{i}", f"urn:c{i % 3}") for i in range(30)] + [(f"urn:s{i}", f"urn:up{j}") for i in range(30) for j in range(4)], key=repr)


def test_a_dictionary_is_aggregated_by_hash_and_finds_shared_numbers(spark, monkeypatch, capsys):
    from quadrille.operators import numbers

    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "b")], "src string, dst string")
    seen, real = [], numbers.cut
    monkeypatch.setattr(numbers, "cut", lambda df, name="cut": (name == "dictionary" and df.explain(), real(df, name))[1])
    # With the first seed all terms get one number, so another seed is taken.
    plain = numbers.number
    monkeypatch.setattr(numbers, "number", lambda text, seed: (seen.append(seed), F.when(text.isNotNull(), F.lit(7).cast("long")) if seed == 0 else plain(text, seed))[1])
    made = numbers.Numbered(edges, ["src", "dst"], distinct=False)
    assert made.seed == 1 and made.terms.count() == 3 and made.rows.count() == 3 and numbers.Numbered(edges, ["src", "dst"]).rows.count() == 2
    assert "SortAggregate" not in capsys.readouterr().out
