"""Queries on patterns, filters, datasets and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.iri import Template
from ..functions.terms import datatype, decode_term, lang, native
from ..model import RDF_TYPE, XSD_STRING, Lit, Val
from ..operators.graph import Dataset, Pattern, UnionGraph
from ..operators.mapping import Col, MappedGraph, Mapping, Rule
from ..operators.patterns import (
    bgp, bind_params, exists, join, join_compatible, join_values, list_graphs, minus, not_exists, optional, values,
)
from .base import BASE, graph, iri, link, prop, query, status_graph, store_of, table

SEGMENT = prop("customer", "c_mktsegment")
PRICE = prop("orders", "o_totalprice")
CUSTOMER = link("orders", "o_custkey")


@query("triple_pattern", f"SELECT {iri('customer')} AS s FROM customer WHERE c_mktsegment = 'BUILDING'")
def triple_pattern(spark, folder):
    return bgp(graph(spark, folder, "customer"), [Pattern("?s", SEGMENT, Lit("BUILDING"))])


@query("project_vars", "SELECT CAST(o_orderdate AS DATE) AS date FROM orders")
def project_vars(spark, folder):
    found = bgp(graph(spark, folder, "orders"), [Pattern("?o", RDF_TYPE, BASE + "orders"), Pattern("?o", prop("orders", "o_orderdate"), Val("?d", "timestamp"))])
    return found.select(F.to_date("d").alias("date"))


@query("select_distinct", "SELECT DISTINCT o_orderpriority AS priority, o_orderstatus AS status FROM orders")
def select_distinct(spark, folder):
    found = bgp(graph(spark, folder, "orders"), [
        Pattern("?o", prop("orders", "o_orderpriority"), Val("?priority", "string")), Pattern("?o", prop("orders", "o_orderstatus"), Val("?status", "string")),
    ])
    return found.select("priority", "status").distinct()


@query("filter_compare", f"SELECT {iri('orders')} AS o, o_totalprice AS price FROM orders WHERE o_totalprice > 300000")
def filter_compare(spark, folder):
    return bgp(graph(spark, folder, "orders"), [Pattern("?o", PRICE, Val("?price"))]).filter("price > 300000")


def texts(spark, folder) -> MappedGraph:
    """Documents of two languages with a language tag each, the others without."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    s = Template(BASE + "documents/doc_id={doc_id}")
    tagged = [
        Mapping(docs.filter(F.col("lang") == tag), (Rule(s, BASE + "text", Col("text", lang=tag)),), unique=True) for tag in ("en", "fr")
    ]
    plain = Mapping(docs.filter(~F.col("lang").isin("en", "fr")), (Rule(s, BASE + "text", Col("text")),), unique=True)
    facts = Mapping(docs, (Rule(s, BASE + "source", Col("source")), Rule(s, BASE + "chars", Col("n_chars"))), unique=True)
    return MappedGraph([*tagged, plain, facts])


@query("filter_boolean_ops", f"""
    SELECT {iri('documents')} AS d, CASE WHEN lang IN ('en', 'fr') THEN lang ELSE '' END AS tag FROM documents
    WHERE (lang = 'en' OR NOT regexp_matches(source, '1$')) AND NOT n_chars < 200 AND (regexp_matches(text, '[.]\\n') OR source IN ('src3', 'src18'))""")
def filter_boolean_ops(spark, folder):
    found = bgp(texts(spark, folder), [
        Pattern("?d", BASE + "text", "?t"), Pattern("?d", BASE + "source", Val("?src", "string")), Pattern("?d", BASE + "chars", "?n"),
    ])
    t, n = F.col("t"), F.col("n")
    keep = (
        ((lang(t) == "en") | ~F.col("src").rlike("1$"))
        & ~(native(n, "long") < 200)
        & (t["value"].rlike(r"[.]\n") | F.col("src").isin("src3", "src18"))
        & t.isNotNull()
        & datatype(t).isin(XSD_STRING)
    )
    return found.filter(keep).select("d", lang(t).alias("tag"))


@query("bind_params", f"SELECT {iri('orders')} AS o FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
def bind_params_query(spark, folder):
    patterns = [Pattern("?o", prop("orders", "o_orderpriority"), "?prio"), Pattern("?o", prop("orders", "o_orderstatus"), "?status")]
    return bgp(graph(spark, folder, "orders"), bind_params(patterns, {"prio": Lit("1-URGENT"), "status": Lit("F")}))


@query("bind_expr", f"SELECT {iri('orders')} AS o, 'http://example.org/invoice/' || o_custkey || '-' || o_orderkey AS invoice FROM orders")
def bind_expr(spark, folder):
    found = bgp(graph(spark, folder, "orders"), [
        Pattern("?o", prop("orders", "o_orderkey"), Val("?key", "long")), Pattern("?o", prop("orders", "o_custkey"), Val("?cust", "long")),
    ])
    made = Template("http://example.org/invoice/{cust}-{key}").column(found.schema)
    return found.select("o", made.alias("invoice"))


@query("dataset_default_graphs", f"""
    SELECT DISTINCT {iri('customer', 'o_custkey')} AS c, o_orderpriority AS priority FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def dataset_default_graphs(spark, folder):
    """Two graphs merged as a set."""
    g = status_graph(spark, folder)
    return bgp(g, [Pattern("?c", BASE + "prefers", Val("?priority", "string"))], Dataset.of(default=["urn:status:F", "urn:status:O"]))


@query("dataset_named_graphs", f"""
    SELECT DISTINCT 'urn:status:' || o_orderstatus AS g, {iri('customer', 'o_custkey')} AS c, o_orderpriority AS priority
    FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def dataset_named_graphs(spark, folder):
    """The same graphs with GRAPH ?g: kept apart."""
    g = status_graph(spark, folder)
    named = Dataset.of(named=["urn:status:F", "urn:status:O"])
    return bgp(g, [Pattern("?c", BASE + "prefers", Val("?priority", "string"), "?g")], named).select("g", "c", "priority")


@query("list_graphs", "SELECT DISTINCT 'urn:status:' || o_orderstatus AS g FROM orders")
def list_graphs_query(spark, folder):
    return list_graphs(status_graph(spark, folder))


@query("term_decode", f"""
    SELECT {iri('orders')} AS s, '<' || {iri('customer', 'o_custkey')} || '>' AS shown, CAST(NULL AS BIGINT) AS n FROM orders
    UNION ALL SELECT {iri('orders')}, o_orderstatus, NULL FROM orders
    UNION ALL SELECT {iri('orders')}, CAST(o_custkey AS VARCHAR), o_custkey FROM orders""")
def term_decode(spark, folder):
    """Tagged terms to text, and to a number where they are one."""
    g = graph(spark, folder, "orders")
    parts = [bgp(g, [Pattern("?s", p, "?o")]) for p in (CUSTOMER, prop("orders", "o_orderstatus"), prop("orders", "o_custkey"))]
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    o = F.col("o")
    return found.select("s", decode_term(o["type"], o["value"]).alias("shown"), native(o, "long").alias("n"))


@query("bgp_star_join", f"""
    SELECT {iri('documents', 'd.doc_id')} AS d, d.source AS source, d.n_chars AS chars, CAST(l.quality AS BIGINT) AS quality
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def bgp_star_join(spark, folder):
    """One subject, two sources: each source is scanned once, then joined on the subject."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    s = Template(BASE + "documents/doc_id={doc_id}")
    g = MappedGraph([
        Mapping(docs, (Rule(s, BASE + "source", Col("source")), Rule(s, BASE + "chars", Col("n_chars"))), unique=True),
        Mapping(labels, (Rule(s, BASE + "quality", Col("quality")),), unique=True),
    ])
    return bgp(g, [
        Pattern("?d", BASE + "source", Val("?source", "string")), Pattern("?d", BASE + "chars", Val("?chars", "long")),
        Pattern("?d", BASE + "quality", Val("?quality", "long")),
    ]).select("d", "source", "chars", "quality")


@query("stored_star_join", f"""
    SELECT {iri('documents', 'd.doc_id')} AS d, d.source AS source, d.n_chars AS chars, CAST(l.quality AS BIGINT) AS quality
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 0""")
def stored_star_join(spark, folder):
    """Four patterns on one subject of a stored graph that is also laid out by subject: one scan."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    s = Template(BASE + "documents/doc_id={doc_id}")
    data = MappedGraph([
        Mapping(docs, tuple(Rule(s, BASE + name, Col(c)) for name, c in (("source", "source"), ("chars", "n_chars"), ("lang", "lang"))), unique=True),
        Mapping(labels, (Rule(s, BASE + "quality", Col("quality")), Rule(s, BASE + "toxic", Col("toxic"))), unique=True),
    ])
    store = store_of(spark, data.quads())
    store.cluster()
    found = bgp(store.graph(), [
        Pattern("?d", BASE + "source", Val("?source", "string")), Pattern("?d", BASE + "chars", Val("?chars", "long")),
        Pattern("?d", BASE + "quality", Val("?quality", "long")), Pattern("?d", BASE + "toxic", Val("?toxic", "long")),
    ])
    return found.filter("toxic = 0").select("d", "source", "chars", "quality")


@query("bgp_path_join", f"""
    SELECT {iri('orders')} AS o, c_name AS customer, n_name AS nation, r_name AS region
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def bgp_path_join(spark, folder):
    g = graph(spark, folder, "orders", "customer", "nation", "region")
    return bgp(g, [
        Pattern("?o", CUSTOMER, "?c"), Pattern("?c", prop("customer", "c_name"), Val("?customer", "string")),
        Pattern("?c", link("customer", "c_nationkey"), "?n"), Pattern("?n", prop("nation", "n_name"), Val("?nation", "string")),
        Pattern("?n", link("nation", "n_regionkey"), "?r"), Pattern("?r", prop("region", "r_name"), Val("?region", "string")),
    ]).select("o", "customer", "nation", "region")


@query("filter_cross_pattern", f"""
    SELECT DISTINCT {iri('orders')} AS o, o_orderdate AS ordered, l_shipdate AS shipped
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate""")
def filter_cross_pattern(spark, folder):
    """Orders shipped before they were placed."""
    lines = Mapping(table(spark, folder, "lineitem"), (Rule(Template(BASE + "orders/o_orderkey={l_orderkey}"), BASE + "shipped", Col("l_shipdate")),))
    g = MappedGraph([*graph(spark, folder, "orders").mappings, lines])
    found = bgp(g, [
        Pattern("?o", BASE + "shipped", Val("?shipped", "timestamp")), Pattern("?o", prop("orders", "o_orderdate"), Val("?ordered", "timestamp")),
    ])
    return found.filter("shipped < ordered").select("o", "ordered", "shipped")


@query("virtual_graph_join", f"""
    SELECT {iri('documents', 'd.doc_id')} AS d, source, CAST(quality AS BIGINT) AS quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def virtual_graph_join(spark, folder):
    """Stored labels join documents that stay a mapped table."""
    labels = table(spark, folder, "labels")
    s = Template(BASE + "documents/doc_id={doc_id}")
    stored = store_of(spark, MappedGraph([Mapping(labels, (Rule(s, BASE + "quality", Col("quality")),), unique=True)]).quads())
    both = UnionGraph(stored.graph(), graph(spark, folder, "documents"), disjoint=True)
    return bgp(both, [
        Pattern("?d", BASE + "quality", Val("?quality", "long")), Pattern("?d", prop("documents", "source"), Val("?source", "string")),
    ]).select("d", "source", "quality")


@query("optional_left_join", f"""
    WITH left_side AS (SELECT d.doc_id, source, CAST(quality AS BIGINT) AS q FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
         right_side AS (SELECT DISTINCT source, CAST(quality AS BIGINT) AS q FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
    SELECT {iri('documents', 'a.doc_id')} AS d, a.source AS source, b.q AS q, a.q IS NOT NULL AS labelled
    FROM left_side a JOIN right_side b ON a.source = b.source AND (a.q = b.q OR a.q IS NULL)""")
def optional_left_join(spark, folder):
    """Documents with an optional label, then joined with the labels seen in their source: an unbound label meets all of them."""
    g = graph(spark, folder, "documents", "labels")
    docs = bgp(g, [Pattern("?d", prop("documents", "source"), Val("?source", "string"))])
    quality = bgp(g, [Pattern("?l", prop("labels", "quality"), Val("?q", "long")), Pattern("?l", link("labels", "doc_id"), "?d")]).select("d", "q")
    left = optional(docs, quality).withColumn("labelled", F.col("q").isNotNull())
    seen = join(docs, quality).select("source", "q").distinct()
    return join_compatible(left, seen, "q").select("d", "source", "q", "labelled")


def big_orders(g):
    return bgp(g, [Pattern("?o", PRICE, Val("?price")), Pattern("?o", CUSTOMER, "?c")]).filter("price > 450000").select("c", "o")


@query("exists_semi_join", f"SELECT {iri('customer')} AS c FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def exists_semi_join(spark, folder):
    g = graph(spark, folder, "customer", "orders")
    return exists(bgp(g, [Pattern("?c", RDF_TYPE, BASE + "customer")]), big_orders(g))


@query("not_exists_anti_join", f"SELECT {iri('customer')} AS c FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def not_exists_anti_join(spark, folder):
    g = graph(spark, folder, "customer", "orders")
    return not_exists(bgp(g, [Pattern("?c", RDF_TYPE, BASE + "customer")]), big_orders(g))


@query("minus_anti_join", f"SELECT {iri('documents')} AS d FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def minus_anti_join(spark, folder):
    g = graph(spark, folder, "documents", "labels")
    docs = bgp(g, [Pattern("?d", RDF_TYPE, BASE + "documents")])
    toxic = bgp(g, [Pattern("?l", prop("labels", "toxic"), Val("?t", "long")), Pattern("?l", link("labels", "doc_id"), "?d")]).filter("t = 1")
    kept = minus(docs, toxic.select("d"))
    # Nothing is taken away by solutions that share no variable.
    return minus(kept, toxic.select("t"))


@query("values_join", f"SELECT {iri('customer')} AS c, c_mktsegment AS segment, CASE c_mktsegment WHEN 'BUILDING' THEN 1 ELSE 2 END :: BIGINT AS rank FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def values_join(spark, folder):
    found = bgp(graph(spark, folder, "customer"), [Pattern("?c", SEGMENT, "?v")])
    inline = values(spark, ["v", "rank"], [(Lit("BUILDING"), 1), (Lit("MACHINERY"), 2), (Lit("NOWHERE"), 3)])
    return join_values(found, inline).select("c", F.col("v.value").alias("segment"), "rank")

