import random
import re

import pytest

from conftest import rows
from quadrille.model import RDF_TYPE, RDFS_SUBCLASS, XSD_DATETIME, XSD_INTEGER, Lit, Val, quads
from quadrille.operators.graph import Dataset, Pattern, StoredGraph
from quadrille.operators.patterns import bgp
from quadrille.operators.reasoning import subclass_closure
from quadrille.operators.shapes import KINDS, Shape, Validation, limit_per_shape, report, report_violations
from quadrille.operators.store import GraphStore
from quadrille.session import scratch

M = "urn:made:"


def terms(rng, kind, good):
    """A value that a constraint of this kind accepts, or one that it does not."""
    k = rng.randrange(1000)
    return {
        "class": (f"{M}box{k % 7}", rng.choice([Lit(f"box{k % 7}"), f"{M}bag{k % 7}"])),
        "datatype": (Lit(str(k), XSD_INTEGER), rng.choice([Lit(str(k)), Lit("some", XSD_INTEGER), Lit(str(k), lang="en"), f"{M}{k}"])),
        "in": (rng.choice([Lit("low"), M + "high"]), rng.choice([Lit("low", lang="en"), M + "low", Lit("other")])),
        "pattern": (Lit(f"A-{k}"), rng.choice([Lit(f"a-{k}"), f"{M}A-x", Lit("")])),
    }.get(kind, (Lit(str(k)),) * 2)[0 if good else 1]


def made(kind, seed):
    """Triples of nodes that keep a constraint of one kind and of nodes that break it, and the constraints."""
    rng, out = random.Random(f"{kind}{seed}"), set()
    path, cls = f"{M}{kind}/path", f"{M}{kind}/Class"
    for i in range(7):
        out.add((f"{M}box{i}", RDF_TYPE, M + "Box"))
    for i in range(14):
        node, good = f"{M}{kind}/{i}", i % 2 == 0
        if kind in ("min", "max"):
            values = {"min": rng.randint(2, 4) if good else rng.randint(0, 1), "max": rng.randint(0, 2) if good else rng.randint(3, 5)}[kind]
            out |= {(node, path, Lit(str(j))) for j in range(values)}
            if rng.random() < 0.8:  # the others are no targets
                out.add((node, RDF_TYPE, cls))
        elif kind in ("domain", "subclass"):
            out |= {(node, path, terms(rng, kind, True)) for _ in range(rng.randint(1, 3))}
            out.add((node, RDF_TYPE, cls))
            if good:
                out.add((node, RDF_TYPE, M + "Wide"))
        else:
            out |= {(node, path, terms(rng, kind, True)) for _ in range(rng.randint(0, 3))}
            if not good:
                out.add((node, path, terms(rng, kind, False)))
    arg = {"min": 2, "max": 2, "class": M + "Box", "datatype": XSD_INTEGER, "domain": M + "Wide", "in": [Lit("low"), M + "high"], "subclass": M + "Wide", "pattern": "^A-[0-9]+$"}[kind]
    shapes = [Shape(kind, kind, "" if kind == "subclass" else path, arg, cls if kind in ("min", "max", "subclass") else "", f"urn:shapes:{len(kind) % 2}")]
    if kind in ("min", "max"):
        shapes.append(Shape(f"any {kind}", kind, path, arg))  # without a target: every subject of the path
        shapes.append(Shape(f"empty {kind}", kind, path, arg, M + "Nobody"))
    return out, shapes


def everything(seed):
    parts = [made(kind, seed) for kind in KINDS]
    return sorted(set().union(*(t for t, _ in parts)), key=repr), [s for _, some in parts for s in some]


def broken(triples, shapes, supers=()):
    """Violations by looking at every triple for every constraint."""
    def is_a(node, cls, wide=True):
        found = {o for s, p, o in triples if s == node and p == RDF_TYPE}
        return cls in found or wide and any((c, cls) in supers for c in found if isinstance(c, str))

    out, subjects = [], {s for s, _, _ in triples}
    for sh in shapes:
        values = {n: [o for s, p, o in triples if s == n and p == sh.path] for n in subjects}
        if sh.kind in ("min", "max"):
            for n in subjects:
                if is_a(n, sh.target_class) if sh.target_class else values[n]:
                    if len(values[n]) < sh.arg if sh.kind == "min" else len(values[n]) > sh.arg:
                        out.append((sh.name, n, sh.path, "", sh.kind))
        elif sh.kind == "domain":
            out += [(sh.name, n, sh.path, "", "domain") for n in subjects if values[n] and not is_a(n, sh.arg)]
        elif sh.kind == "subclass":
            out += [(sh.name, n, "", "", "subclass") for n in subjects if is_a(n, sh.target_class, False) and not is_a(n, sh.arg, False)]
        for n, found in values.items():
            for o in found if sh.kind in ("class", "datatype", "in", "pattern") else ():
                text = o.value if isinstance(o, Lit) else o
                good = {
                    "class": lambda: isinstance(o, str) and is_a(o, sh.arg), "in": lambda: o in sh.arg, "pattern": lambda: re.search(sh.arg, text),
                    "datatype": lambda: isinstance(o, Lit) and o.datatype == sh.arg and re.fullmatch(r"[+-]?\d+", text),
                }[sh.kind]()
                if not good:
                    out.append((sh.name, n, sh.path, text, sh.kind))
    return sorted(out)


ALL = ("shape", "focus", "path", "value", "kind")


@pytest.mark.parametrize("kind", KINDS)
def test_each_kind_against_a_look_at_every_triple(spark, kind):
    triples, shapes = made(kind, 1)
    want = broken(triples, shapes)
    hit = {w[1] for w in want}
    assert 3 <= len([n for n in hit if "/" in n]) < 14  # some nodes keep it, some break it
    assert rows(Validation(StoredGraph(quads(spark, triples)), shapes).violations(), *ALL) == want


def test_all_kinds_together(spark):
    triples, shapes = everything(2)
    assert rows(Validation(StoredGraph(quads(spark, triples)), shapes).violations(), *ALL) == broken(triples, shapes)


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_two_scans_whatever_the_number_of_shapes(spark, monkeypatch):
    from quadrille.operators import shapes as module

    triples, some = everything(3)
    store = GraphStore.create(spark, scratch(spark), quads(spark, triples))
    many = [Shape(f"{s.name} {k}", s.kind, s.path, s.arg, s.target_class) for s in some for k in range(90)]
    counts = [s for s in many if s.kind in ("min", "max", "domain", "subclass")]
    assert len(many) >= 1000
    found = Validation(store.graph(), counts).violations()
    assert scans(found) == 2 and found.count() == 90 * len(broken(triples, [s for s in some if s.kind in ("min", "max", "domain", "subclass")]))
    read, before = [], module.cut
    monkeypatch.setattr(module, "cut", lambda df, name="cut": (read.append(scans(df)), before(df, name))[1])
    assert Validation(store.graph(), many).violations().count() == 90 * len(broken(triples, some))
    assert read == [1, 1]  # values and types of all kinds, each read once


@pytest.fixture(scope="module")
def given(spark):
    triples, shapes = everything(4)
    return StoredGraph(quads(spark, triples).cache()), triples, shapes


def test_dates_of_two_patterns(spark):
    rng = random.Random(5)
    days = [(f"{M}{k}", rng.randint(1, 28), rng.randint(1, 28)) for k in range(30)]
    triples = [(n, f"{M}{p}", Lit(f"2020-05-{d:02d}T10:00:00Z", XSD_DATETIME)) for n, a, b in days for p, d in (("from", a), ("to", b))]
    found = bgp(StoredGraph(quads(spark, triples)), [Pattern("?i", M + "to", Val("?b", "timestamp")), Pattern("?i", M + "from", Val("?a", "timestamp"))])
    assert rows(found.filter("b < a"), "i") == sorted((n,) for n, a, b in days if b < a)


def test_subclass_constraint(spark):
    shape = [Shape("m", "subclass", arg="urn:Employee", target_class="urn:Manager")]
    assert Validation(StoredGraph(quads(spark, [("urn:z", "urn:p", "urn:q")])), shape).is_valid().first()["valid"] is True
    alice = [("urn:Alice", RDF_TYPE, "urn:Manager")]
    assert Validation(StoredGraph(quads(spark, alice)), shape).is_valid().first()["valid"] is False
    both = StoredGraph(quads(spark, [*alice, ("urn:Alice", RDF_TYPE, "urn:Employee")]))
    assert Validation(both, shape).is_valid().first()["valid"] is True


def test_targets_through_subclasses(spark):
    g = StoredGraph(quads(spark, [("urn:i", RDF_TYPE, "urn:Sub"), ("urn:Sub", RDFS_SUBCLASS, "urn:Top"), ("urn:j", "urn:link", "urn:i")]))
    shapes = [Shape("m", "min", "urn:p", 1, "urn:Top"), Shape("c", "class", "urn:link", "urn:Top")]
    closure = subclass_closure(g)
    assert rows(report_violations(g, shapes, closure), "shape") == [("m",)]
    assert rows(report_violations(g, shapes, closure, **{"shacl.targetClass.simple": True}), "shape") == [("c",)]


def test_datatypes(spark):
    g = StoredGraph(quads(spark, [
        ("urn:a", "urn:n", Lit("5", XSD_INTEGER)), ("urn:b", "urn:n", Lit("five", XSD_INTEGER)), ("urn:c", "urn:n", Lit("5")), ("urn:d", "urn:n", "urn:5"),
    ]))
    assert rows(Validation(g, [Shape("n", "datatype", "urn:n", XSD_INTEGER)]).violations(), "focus") == [("urn:b",), ("urn:c",), ("urn:d",)]


def test_report_options(given, spark):
    graph, triples, shapes = given
    want = broken(triples, shapes)
    assert report(graph, []).first()["conforms"] is True
    got = report(graph, shapes).first()
    assert (got["conforms"], got["violations"]) == (False, len(want))
    with pytest.raises(ValueError, match="Parameter not recognized"):
        report(graph, shapes, invalidKey="invalidParam")
    with pytest.raises(ValueError, match="Parameter not recognized"):
        report(graph, shapes, shapes="max", invalidKey="x")
    assert report(graph, shapes, shapes="max").first()["violations"] == sum(w[0] == "max" for w in want)
    part = [s for s in shapes if s.graph == "urn:shapes:1"]
    assert 0 < len(part) < len(shapes) and report(graph, shapes, **{"shacl.shape.graphs": "urn:shapes:1"}).first()["violations"] == len(broken(triples, part))
    nodes = sorted({w[1] for w in want})[::5]
    assert rows(report_violations(graph, shapes, nodes=nodes), *ALL) == [w for w in want if w[1] in nodes]
    assert report(graph, shapes, nodes=nodes[0]).first()["violations"] == sum(w[1] == nodes[0] for w in want)
    assert report(graph, shapes, countLimit=3).first()["violations"] == 3
    assert report(graph, shapes, **{"graph-uri": "urn:empty"}).first()["conforms"] is True
    assert report(graph, shapes, reasoning=True).first()["violations"] == len(want)


def test_limit_per_shape(spark):
    data = [("hot", f"f{i:04d}", "p", "", "min") for i in range(500)] + [("cold", "f", "p", "", "min")]
    df = spark.createDataFrame(data, "shape string, focus string, path string, value string, kind string").repartition(7)
    got = rows(limit_per_shape(df, 3), "shape", "focus")
    assert got == [("cold", "f"), ("hot", "f0000"), ("hot", "f0001"), ("hot", "f0002")]
    assert Dataset.of().given is False


def test_values_of_numeric_types_and_terms_of_lists(spark):
    cases = {
        "nonNegativeInteger": ("0 007 +5 " + "9" * 20, "-5 1.0 x"), "integer": ("-5 " + "9" * 40, "1.5 1e3"), "byte": ("-128 127 0127", "-129 128"),
        "positiveInteger": ("1 10", "0 -1"), "negativeInteger": ("-1", "0 1"), "unsignedLong": (f"{2**64 - 1}", f"{2**64}"), "decimal": ("1. .5 -3", "1e5"),
        "double": ("1e5 INF NaN", "one"), "long": (f"{-2**63} {2**63 - 1}", f"{-2**63 - 1} {2**63}"),
    }
    base = "http://www.w3.org/2001/XMLSchema#"
    data = [(f"urn:{k}", f"urn:{k}", Lit(v, base + k)) for k, (good, bad) in cases.items() for v in (good + " " + bad).split()]
    found = Validation(StoredGraph(quads(spark, data)), [Shape(k, "datatype", f"urn:{k}", base + k) for k in cases]).violations()
    assert rows(found, "shape", "value") == sorted((k, v) for k, (_, bad) in cases.items() for v in bad.split())
    data = [("urn:1", "urn:p", Lit("F")), ("urn:2", "urn:p", "F"), ("urn:3", "urn:p", Lit("F", "", "en")), ("urn:4", "urn:p", "urn:ok")]
    assert rows(Validation(StoredGraph(quads(spark, data)), [Shape("x", "in", "urn:p", [Lit("F"), "urn:ok"])]).violations(), "focus") == [("urn:2",), ("urn:3",)]


def test_statements_of_one_path_are_not_shuffled_to_one_task(spark, capsys):
    data = quads(spark, [(f"urn:s{i}", "urn:p", Lit(f"v{i}")) for i in range(50)])
    found = Validation(StoredGraph(data), [Shape("one", "in", "urn:p", [Lit("v1")]), Shape("two", "pattern", "urn:p", "^v2")]).violations()
    found.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert found.count() == 49 + 39
