"""Queries on closed-world constraints over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.iri import Template
from ..model import RDF_TYPE, RDFS_SUBCLASS, XSD_DOUBLE, XSD_STRING, Lit
from ..operators.mapping import Col, MappedGraph, Mapping, Rule
from ..operators.reasoning import subclass_closure
from ..operators.shapes import COLUMNS, Shape, Validation, report, report_violations
from .base import BASE, graph, iri, link, prop, query, table

DOC = Template(BASE + "documents/doc_id={doc_id}")


def facts(spark, folder) -> MappedGraph:
    """Documents with their language as class and links to labels; users with the kinds of their events; parts by size
    and price; values of events that are text for errors."""
    docs, labels, events, part = (table(spark, folder, t) for t in ("documents", "labels", "events", "part"))
    user, p = Template(BASE + "user/{user_id}"), Template(BASE + "part/p_partkey={p_partkey}")
    event = Template(BASE + "events/event_id={event_id}")
    english = docs.filter(F.col("lang") == "en")
    return MappedGraph([
        Mapping(docs, (Rule(DOC, RDF_TYPE, BASE + "documents"),), unique=True),
        Mapping(english, (Rule(DOC, RDF_TYPE, BASE + "English"),), unique=True),
        Mapping(labels, (Rule(DOC, BASE + "quality", Col("quality")),), unique=True),
        Mapping(events, (Rule(user, BASE + "did", Col("event_type")),)),
        Mapping(events.filter("event_type = 'error'"), (Rule(event, BASE + "value", Col("value", XSD_STRING)),), unique=True),
        Mapping(events.filter("event_type <> 'error'"), (Rule(event, BASE + "value", Col("value")),), unique=True),
        Mapping(part.filter("p_size < 10"), (Rule(p, RDF_TYPE, BASE + "Small"),), unique=True),
        Mapping(part.filter("p_retailprice < 950"), (Rule(p, RDF_TYPE, BASE + "Cheap"),), unique=True),
    ])


def checked(spark, folder, *shapes: Shape):
    return Validation(facts(spark, folder), list(shapes)).violations()


def row(shape: str, focus: str, path: str, value: str, kind: str) -> str:
    return f"SELECT '{shape}' AS shape, {focus} AS focus, '{path}' AS path, {value} AS value, '{kind}' AS kind"


MIN = Shape("labelled", "min", BASE + "quality", 1, BASE + "documents")
MIN_SQL = row("labelled", iri("documents"), MIN.path, "''", "min") + " FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
MAX = Shape("few kinds", "max", BASE + "did", 4)
MAX_SQL = row("few kinds", f"'{BASE}user/' || user_id", MAX.path, "''", "max") + " FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 4"
DOMAIN = Shape("english only", "domain", BASE + "quality", BASE + "English")
DOMAIN_SQL = row("english only", iri("documents", "l.doc_id"), DOMAIN.path, "''", "domain") + " FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE lang <> 'en'"
SUB = Shape("small is cheap", "subclass", arg=BASE + "Cheap", target_class=BASE + "Small")
SUB_SQL = row("small is cheap", iri("part"), "", "''", "subclass") + " FROM part WHERE p_size < 10 AND NOT p_retailprice < 950"


@query("shape_min_count", MIN_SQL)
def shape_min_count(spark, folder):
    return checked(spark, folder, MIN)


@query("shape_max_count", MAX_SQL)
def shape_max_count(spark, folder):
    return checked(spark, folder, MAX)


def solvent(spark, folder) -> MappedGraph:
    """Orders, and customers with a balance as class Solvent."""
    customers = table(spark, folder, "customer").filter("c_acctbal >= 0")
    rule = Rule(Template(BASE + "customer/c_custkey={c_custkey}"), RDF_TYPE, BASE + "Solvent")
    return MappedGraph([*graph(spark, folder, "orders").mappings, Mapping(customers, (rule,), unique=True)])


CLASS = Shape("solvent customer", "class", link("orders", "o_custkey"), BASE + "Solvent")
CLASS_SQL = row("solvent customer", iri("orders"), CLASS.path, iri("customer", "o_custkey"), "class") + " FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0"


@query("shape_class", CLASS_SQL)
def shape_class(spark, folder):
    """One customer may hold many orders; the anti-join splits such keys at run time."""
    return Validation(solvent(spark, folder), [CLASS]).violations()


@query("shape_datatype", f"SELECT 'number' AS shape, {iri('events')} AS focus, '{BASE}value' AS path, value AS number, 'datatype' AS kind FROM events WHERE event_type = 'error'")
def shape_datatype(spark, folder):
    found = checked(spark, folder, Shape("number", "datatype", BASE + "value", XSD_DOUBLE))
    return found.select("shape", "focus", "path", F.col("value").cast("double").alias("number"), "kind")


@query("shape_domain", DOMAIN_SQL)
def shape_domain(spark, folder):
    return checked(spark, folder, DOMAIN)


IN = Shape("status", "in", prop("orders", "o_orderstatus"), [Lit("F"), Lit("O")])
IN_SQL = row("status", iri("orders"), IN.path, "o_orderstatus", "in") + " FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"


@query("shape_in", IN_SQL)
def shape_in(spark, folder):
    return Validation(graph(spark, folder, "orders"), [IN]).violations()


@query("shape_subclass", SUB_SQL)
def shape_subclass(spark, folder):
    return checked(spark, folder, SUB)


@query("shape_pattern", row("secure", iri("pages"), prop("pages", "url"), "url", "pattern") + " FROM pages WHERE NOT regexp_matches(url, '^https://[a-z.]+/')")
def shape_pattern(spark, folder):
    return Validation(graph(spark, folder, "pages"), [Shape("secure", "pattern", prop("pages", "url"), "^https://[a-z.]+/")]).violations()


EVERY = " UNION ALL ".join(f"({q})" for q in (MIN_SQL, MAX_SQL, DOMAIN_SQL, SUB_SQL))
SHAPES = [MIN, MAX, DOMAIN, SUB]


@query("is_valid", f"SELECT count(*) = 0 AS valid FROM ({EVERY})")
def is_valid(spark, folder):
    return Validation(facts(spark, folder), SHAPES).is_valid()


@query("violations", EVERY)
def violations(spark, folder):
    return Validation(facts(spark, folder), SHAPES).violations().select(*COLUMNS)


@query("validation_report", f"SELECT count(*) = 0 AS conforms, count(*) AS violations FROM ({EVERY})")
def validation_report(spark, folder):
    return report(facts(spark, folder), SHAPES)


@query("report_focus_nodes", f"SELECT * FROM ({EVERY}) WHERE focus IN (SELECT {iri('documents')} FROM documents WHERE source IN ('src1', 'src2'))")
def report_focus_nodes(spark, folder):
    """Only the documents of two sources are checked."""
    docs = table(spark, folder, "documents").filter(F.col("source").isin("src1", "src2"))
    nodes = docs.select(DOC.column(docs.schema).alias("focus"))
    return report_violations(facts(spark, folder), SHAPES, nodes=nodes)


@query("report_shape_select", f"{MIN_SQL} UNION ALL ({SUB_SQL})")
def report_shape_select(spark, folder):
    """Two of four shapes, from the shape graph they are in."""
    shapes = [Shape(s.name, s.kind, s.path, s.arg, s.target_class, "urn:shapes:a" if s is not MAX else "urn:shapes:b") for s in SHAPES]
    options = {"shapes": ["labelled", "small is cheap", "few kinds"], "shacl.shape.graphs": "urn:shapes:a"}
    return report_violations(facts(spark, folder), shapes, **options)


@query("report_target_simple", f"""
    SELECT 'through subclasses' AS mode, count(*) AS violations FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'stored types', count(*) FROM documents WHERE lang = 'fr' AND doc_id NOT IN (SELECT doc_id FROM labels)""")
def report_target_simple(spark, folder):
    """The target class reaches documents of all languages through subclasses, and French ones by stored type."""
    docs = table(spark, folder, "documents")
    language = Template(BASE + "lang/{lang}")
    g = MappedGraph([
        Mapping(docs, (Rule(DOC, RDF_TYPE, language),), unique=True),
        Mapping(docs.filter("lang = 'fr'"), (Rule(DOC, RDF_TYPE, BASE + "Document"),), unique=True),
        Mapping(docs.select("lang").distinct(), (Rule(language, RDFS_SUBCLASS, BASE + "Document"),), unique=True),
        Mapping(table(spark, folder, "labels"), (Rule(DOC, BASE + "quality", Col("quality")),), unique=True),
    ])
    shapes = [Shape("labelled", "min", BASE + "quality", 1, BASE + "Document")]
    closure = subclass_closure(g)
    wide = report(g, shapes, closure).select(F.lit("through subclasses").alias("mode"), "violations")
    simple = report(g, shapes, closure, **{"shacl.targetClass.simple": True}).select(F.lit("stored types").alias("mode"), "violations")
    return wide.unionByName(simple)
