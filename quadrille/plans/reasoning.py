"""Queries on inference. Class hierarchies are read from the tables: brands below types below Part below Thing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.iri import Template
from ..model import DEFAULT_GRAPH, OWL_DISJOINT, OWL_FUNCTIONAL, RDF_TYPE, RDFS_DOMAIN, RDFS_RANGE, RDFS_SUBCLASS, RDFS_SUBPROPERTY, quads
from ..operators.graph import Pattern, StoredGraph, UnionGraph
from ..operators.mapping import Col, MappedGraph, Mapping, Rule
from ..operators.patterns import bgp, construct
from ..operators.reasoning import (
    ReasonedGraph, contradictions, domain_range_schema, domain_range_types, explain_inference, explain_statements, infer_types, instances, is_consistent, subclass_closure,
)
from .base import BASE, iri, query, store_of, table

BRAND, TYPE = BASE + "brand/", BASE + "type/"


def class_graph(spark, folder, graphs: bool = False) -> UnionGraph:
    """Parts with their brand as class, and the hierarchy; with ``graphs`` each level sits in a graph of its own."""
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    brand, type_ = Template(BRAND + "{p_brand}"), Template(TYPE + "{p_type}")
    low, high = ("urn:schema:brands", "urn:schema:types") if graphs else (DEFAULT_GRAPH, DEFAULT_GRAPH)
    top = StoredGraph(quads(spark, [(BASE + "Part", RDFS_SUBCLASS, BASE + "Thing")], high))
    mapped = MappedGraph([
        Mapping(part, (Rule(Template(BASE + "part/p_partkey={p_partkey}"), RDF_TYPE, brand),), unique=True),
        Mapping(part, (Rule(brand, RDFS_SUBCLASS, type_),), low),
        Mapping(part, (Rule(type_, RDFS_SUBCLASS, BASE + "Part"),), high),
    ])
    return UnionGraph(top, mapped, disjoint=True)


BRAND_SQL, TYPE_SQL = f"'{BRAND}' || replace(p_brand, '#', '%23')", f"'{TYPE}' || p_type"
EDGES = f"""
    SELECT DISTINCT {BRAND_SQL} AS sub, {TYPE_SQL} AS super FROM part UNION ALL SELECT DISTINCT {TYPE_SQL}, '{BASE}Part' FROM part"""
CLOSURE = f"""
    {EDGES} UNION ALL SELECT '{BASE}Part', '{BASE}Thing' UNION ALL SELECT DISTINCT {BRAND_SQL}, '{BASE}Part' FROM part
    UNION ALL SELECT DISTINCT {BRAND_SQL}, '{BASE}Thing' FROM part UNION ALL SELECT DISTINCT {TYPE_SQL}, '{BASE}Thing' FROM part"""


@query("subclass_closure", CLOSURE)
def subclass_closure_query(spark, folder):
    return subclass_closure(class_graph(spark, folder)).select("sub", "super")


@query("type_inference", f"""
    WITH closure AS ({CLOSURE}), t AS (SELECT {iri('part')} AS s, {BRAND_SQL} AS cls FROM part)
    SELECT s, cls FROM t UNION SELECT s, super FROM t JOIN closure ON cls = sub""")
def type_inference(spark, folder):
    g = class_graph(spark, folder)
    return infer_types(instances(g), subclass_closure(g))


@query("schema_graph_select", f"""
    SELECT DISTINCT {TYPE_SQL} AS sub, '{BASE}Part' AS super FROM part UNION ALL SELECT DISTINCT {TYPE_SQL}, '{BASE}Thing' FROM part
    UNION ALL SELECT '{BASE}Part', '{BASE}Thing'""")
def schema_graph_select(spark, folder):
    """The schema is read from one of two graphs only."""
    return subclass_closure(class_graph(spark, folder, graphs=True), ["urn:schema:types"]).select("sub", "super")


@query("subproperty_inference", f"""
    SELECT {iri('customer')} AS s, {iri('nation', 'c_nationkey')} AS n FROM customer UNION ALL SELECT {iri('supplier')}, {iri('nation', 's_nationkey')} FROM supplier""")
def subproperty_inference(spark, folder):
    """livesIn and worksIn are both locatedIn, by way of a property in between."""
    customers = Rule(Template(BASE + "customer/c_custkey={c_custkey}"), BASE + "livesIn", Template(BASE + "nation/n_nationkey={c_nationkey}"))
    suppliers = Rule(Template(BASE + "supplier/s_suppkey={s_suppkey}"), BASE + "worksIn", Template(BASE + "nation/n_nationkey={s_nationkey}"))
    data = MappedGraph([
        Mapping(table(spark, folder, "customer"), (customers,), unique=True), Mapping(table(spark, folder, "supplier"), (suppliers,), unique=True),
    ])
    schema = StoredGraph(quads(spark, [
        (BASE + "livesIn", RDFS_SUBPROPERTY, BASE + "residesIn"), (BASE + "residesIn", RDFS_SUBPROPERTY, BASE + "locatedIn"),
        (BASE + "worksIn", RDFS_SUBPROPERTY, BASE + "locatedIn"),
    ]))
    g = ReasonedGraph(UnionGraph(schema, data, disjoint=True))
    return bgp(g, [Pattern("?s", BASE + "locatedIn", "?n")]).select("s", F.col("n.value").alias("n"))


@query("stored_subproperties", f"""
    SELECT {iri('customer')} AS s, {iri('nation', 'c_nationkey')} AS n FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT {iri('supplier')}, {iri('nation', 's_nationkey')} FROM supplier""")
def stored_subproperties(spark, folder):
    """A property per market segment below two parents each, a cycle, and one scan of a stored graph for all of them."""
    customer = table(spark, folder, "customer").filter("c_acctbal >= 0")
    s, n = Template(BASE + "customer/c_custkey={c_custkey}"), Template(BASE + "nation/n_nationkey={c_nationkey}")
    segments = [r[0] for r in table(spark, folder, "customer").select("c_mktsegment").distinct().orderBy("c_mktsegment").limit(100).collect()]
    data = [Mapping(customer.filter(F.col("c_mktsegment") == x), (Rule(s, f"{BASE}in{k}", n),), unique=True) for k, x in enumerate(segments)]
    data.append(Mapping(table(spark, folder, "supplier"), (Rule(Template(BASE + "supplier/s_suppkey={s_suppkey}"), BASE + "worksIn", Template(BASE + "nation/n_nationkey={s_nationkey}")),), unique=True))
    edges = [(f"{BASE}in{k}", up) for k in range(len(segments)) for up in (BASE + "residesIn", BASE + "tradesIn")]
    edges += [(BASE + "residesIn", BASE + "locatedIn"), (BASE + "tradesIn", BASE + "worksIn"), (BASE + "worksIn", BASE + "locatedIn"), (BASE + "locatedIn", BASE + "residesIn")]
    schema = quads(spark, [(a, RDFS_SUBPROPERTY, b) for a, b in edges])
    g = ReasonedGraph(store_of(spark, MappedGraph(data).quads().unionByName(schema)).graph())
    return bgp(g, [Pattern("?s", BASE + "locatedIn", "?n")]).select("s", F.col("n.value").alias("n"))


@query("domain_range_inference", f"""
    SELECT {iri('orders')} AS s, '{BASE}Order' AS cls FROM orders UNION SELECT {iri('customer', 'o_custkey')}, '{BASE}Customer' FROM orders""")
def domain_range_inference(spark, folder):
    """Types from domains and ranges; a literal gets no type from the range of its property."""
    s = Template(BASE + "orders/o_orderkey={o_orderkey}")
    rules = (Rule(s, BASE + "by", Template(BASE + "customer/c_custkey={o_custkey}")), Rule(s, BASE + "status", Col("o_orderstatus")))
    data = MappedGraph([Mapping(table(spark, folder, "orders"), rules, unique=True)])
    schema = StoredGraph(quads(spark, [
        (BASE + "by", RDFS_DOMAIN, BASE + "Order"), (BASE + "by", RDFS_RANGE, BASE + "Customer"), (BASE + "status", RDFS_RANGE, BASE + "Status"),
    ]))
    return domain_range_types(data.quads(), domain_range_schema(schema))


@query("explain_inference", f"""
    WITH first AS (SELECT {BRAND_SQL} AS brand, min({TYPE_SQL}) AS type FROM part GROUP BY 1), t AS (SELECT {iri('part')} AS s, {BRAND_SQL} AS brand FROM part)
    SELECT s, brand AS cls, 'ASSERTED' AS status, brand AS proof FROM t
    UNION ALL SELECT s, '{BASE}Part', 'INFERRED', t.brand || ' > ' || type || ' > {BASE}Part' FROM t JOIN first ON t.brand = first.brand""")
def explain_inference_query(spark, folder):
    """Of every part: its brand class holds as stored, Part is derived, and Order does not hold."""
    g = class_graph(spark, folder)
    types = instances(g)
    asked = types.unionByName(types.withColumn("cls", F.lit(BASE + "Part"))).unionByName(types.withColumn("cls", F.lit(BASE + "orders")))
    found = explain_inference(asked, g.quads(), subclass_closure(g))
    return found.select("s", "cls", "status", F.array_join("proof", " > ").alias("proof"))


@query("explain_statement", f"""
    SELECT {iri('customer')} AS s, 'type Agent' AS statement, 'INFERRED' AS status,
        'livesIn > subproperty residesIn > subproperty locatedIn > domain Resident > subclass Agent' AS proof FROM customer
    UNION ALL SELECT {iri('customer')}, 'locatedIn', 'INFERRED', 'livesIn > subproperty residesIn > subproperty locatedIn' FROM customer
    UNION ALL SELECT {iri('customer')}, 'livesIn', 'ASSERTED', 'livesIn' FROM customer
    UNION ALL SELECT DISTINCT {iri('nation', 'c_nationkey')}, 'type Place', 'INFERRED', 'livesIn > subproperty residesIn > range Place' FROM customer""")
def explain_statement(spark, folder):
    """Proofs by sub-properties, domain, range and subclasses; statements that do not hold are left out."""
    s, n = Template(BASE + "customer/c_custkey={c_custkey}"), Template(BASE + "nation/n_nationkey={c_nationkey}")
    customer = table(spark, folder, "customer")
    data = MappedGraph([Mapping(customer, (Rule(s, BASE + "livesIn", n),), unique=True)])
    schema = StoredGraph(quads(spark, [
        (BASE + "livesIn", RDFS_SUBPROPERTY, BASE + "residesIn"), (BASE + "residesIn", RDFS_SUBPROPERTY, BASE + "locatedIn"),
        (BASE + "locatedIn", RDFS_DOMAIN, BASE + "Resident"), (BASE + "residesIn", RDFS_RANGE, BASE + "Place"), (BASE + "Resident", RDFS_SUBCLASS, BASE + "Agent"),
    ]))
    met = customer.select(s.column(customer.schema).alias("c"), n.column(customer.schema).alias("n"))
    asked = construct(met, [
        Pattern("?c", RDF_TYPE, BASE + "Agent"), Pattern("?c", BASE + "locatedIn", "?n"), Pattern("?c", BASE + "livesIn", "?n"),
        Pattern("?n", RDF_TYPE, BASE + "Place"), Pattern("?n", RDF_TYPE, BASE + "Agent"), Pattern("?c", BASE + "worksIn", "?n"),
    ])
    found = explain_statements(asked, UnionGraph(schema, data, disjoint=True))

    def short(name):
        return F.regexp_extract(name, "([^/#]*)$", 1)

    steps = F.transform("proof", lambda x: F.concat(x["rule"], F.lit(" "), short(F.when(x["rule"] == "subproperty", x["p"]).otherwise(x["o"]))))
    about = F.when(F.col("p") == RDF_TYPE, F.concat(F.lit("type "), short(F.col("o_value")))).otherwise(short(F.col("p")))
    return found.select("s", about.alias("statement"), "status", F.array_join(F.concat(F.array(short(F.col("from_p"))), steps), " > ").alias("proof"))


def contradicting(spark, folder):
    """Labels as classes Good and Toxic, which are disjoint, and the last event type per user as a functional property."""
    labels, events = table(spark, folder, "labels"), table(spark, folder, "events")
    doc = Template(BASE + "documents/doc_id={doc_id}")
    data = MappedGraph([
        Mapping(labels.filter("quality = 1"), (Rule(doc, RDF_TYPE, BASE + "Good"),), unique=True),
        Mapping(labels.filter("toxic = 1"), (Rule(doc, RDF_TYPE, BASE + "Toxic"),), unique=True),
        Mapping(events, (Rule(Template(BASE + "user/{user_id}"), BASE + "prefers", Col("event_type")),)),
    ])
    schema = quads(spark, [(BASE + "Good", OWL_DISJOINT, BASE + "Toxic"), (BASE + "prefers", RDF_TYPE, OWL_FUNCTIONAL)])
    return data.quads(), schema


@query("consistency_check", """
    SELECT NOT EXISTS (SELECT 1 FROM labels WHERE quality = 1 AND toxic = 1)
       AND NOT EXISTS (SELECT 1 FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1) AS consistent""")
def consistency_check(spark, folder):
    return is_consistent(*contradicting(spark, folder))


@query("explain_inconsistency", f"""
    SELECT 'disjoint' AS kind, {iri('documents')} AS s, '{RDF_TYPE}' AS p, '{BASE}Good' AS first, '{BASE}Toxic' AS second FROM labels WHERE quality = 1 AND toxic = 1
    UNION ALL SELECT 'functional', '{BASE}user/' || user_id, '{BASE}prefers', min(event_type), max(event_type) FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1""")
def explain_inconsistency(spark, folder):
    return contradictions(*contradicting(spark, folder))

