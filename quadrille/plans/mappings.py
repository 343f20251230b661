"""Queries on mapping tables and JSON to graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.iri import Template
from ..model import DEFAULT_GRAPH, RDF_TYPE, XSD_DATETIME, XSD_DOUBLE, XSD_INTEGER, Val
from ..operators.caches import materialize, virtual_view
from ..operators.graph import Pattern
from ..operators.mapping import Col, MappedGraph, Mapping, Rule
from ..operators.patterns import bgp
from .base import BASE, graph, iri, link, prop, query, store_of, table


@query("iri_template", "SELECT 'http://example.org/shop/' || replace(p_name, ' ', '%20') || '/' || p_partkey AS s, p_name AS name FROM part")
def iri_template(spark, folder):
    subject = Template("http://example.org/shop/{p_name}/{p_partkey}")
    g = MappedGraph([Mapping(table(spark, folder, "part"), (Rule(subject, BASE + "name", Col("p_name")),), unique=True)])
    return bgp(g, [Pattern("?s", BASE + "name", Val("?name", "string"))])


@query("mapped_table_to_triples", f"""
    SELECT {iri('part')} AS s, '{RDF_TYPE}' AS p, '{BASE}Part' AS o_value, '' AS o_datatype FROM part
    UNION ALL SELECT {iri('part')}, '{BASE}name', p_name, '' FROM part
    UNION ALL SELECT {iri('part')}, '{BASE}size', CAST(p_size AS VARCHAR), '{XSD_INTEGER}' FROM part
    UNION ALL SELECT {iri('part')}, '{BASE}brand', p_brand, '' FROM part WHERE p_brand <> 'Brand#2'""")
def mapped_table_to_triples(spark, folder):
    """Several triples per row from one scan; a NULL column makes none."""
    part = table(spark, folder, "part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#2")))
    s = Template(BASE + "part/p_partkey={p_partkey}")
    rules = (Rule(s, RDF_TYPE, BASE + "Part"), Rule(s, BASE + "name", Col("p_name")), Rule(s, BASE + "size", Col("p_size")), Rule(s, BASE + "brand", Col("p_brand")))
    return MappedGraph([Mapping(part, rules, unique=True)]).quads().select("s", "p", "o_value", "o_datatype")


@query("mapping_filtered_source", f"""
    SELECT {iri('orders')} AS o, CASE WHEN o_orderpriority = '1-URGENT' THEN '{BASE}UrgentOrder' ELSE '{BASE}LowOrder' END AS cls
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""")
def mapping_filtered_source(spark, folder):
    """Rows choose the class."""
    orders, s = table(spark, folder, "orders"), Template(BASE + "orders/o_orderkey={o_orderkey}")
    g = MappedGraph([
        Mapping(orders.filter(F.col("o_orderpriority") == value), (Rule(s, RDF_TYPE, BASE + cls),), unique=True)
        for value, cls in (("1-URGENT", "UrgentOrder"), ("5-LOW", "LowOrder"))
    ])
    return bgp(g, [Pattern("?o", RDF_TYPE, "?cls")], ).select("o", F.col("cls.value").alias("cls"))


@query("mapping_link_table", f"SELECT DISTINCT {iri('orders', 'l_orderkey')} AS o, {iri('part', 'l_partkey')} AS part FROM lineitem")
def mapping_link_table(spark, folder):
    """A table without a key of its own: rows that give the same edge are one edge."""
    rule = Rule(Template(BASE + "orders/o_orderkey={l_orderkey}"), BASE + "contains", Template(BASE + "part/p_partkey={l_partkey}"))
    g = MappedGraph([Mapping(table(spark, folder, "lineitem"), (rule,))])
    return bgp(g, [Pattern("?o", BASE + "contains", "?part")]).select("o", F.col("part.value").alias("part"))


@query("mapping_json_explode", f"""
    WITH k AS (SELECT event_id, event_type, unnest(json_keys(props)) AS name, props FROM events), v AS (SELECT *, CAST(json_extract(props, '$.' || name) AS BIGINT) AS value FROM k)
    SELECT {iri('events')} AS s, '{RDF_TYPE}' AS p, '{BASE}Event' AS o_value FROM events
    UNION ALL SELECT {iri('events')}, '{BASE}type', event_type FROM events
    UNION ALL SELECT DISTINCT {iri('events')}, '{BASE}includes', '{BASE}prop/' || name || '/' || value FROM v
    UNION ALL SELECT DISTINCT '{BASE}prop/' || name || '/' || value, '{RDF_TYPE}', '{BASE}Prop' FROM v
    UNION ALL SELECT DISTINCT '{BASE}prop/' || name || '/' || value, '{BASE}value', CAST(value AS VARCHAR) FROM v""")
def mapping_json_explode(spark, folder):
    """A JSON object with its elements: parents once per object, children once each however many parents they have."""
    events = table(spark, folder, "events")
    elements = events.select("event_id", F.explode(F.from_json("props", "map<string, bigint>")).alias("name", "value"))
    event, prop_ = Template(BASE + "events/event_id={event_id}"), Template(BASE + "prop/{name}/{value}")
    g = MappedGraph([
        Mapping(events, (Rule(event, RDF_TYPE, BASE + "Event"), Rule(event, BASE + "type", Col("event_type"))), unique=True),
        Mapping(elements, (Rule(event, BASE + "includes", prop_), Rule(prop_, RDF_TYPE, BASE + "Prop"), Rule(prop_, BASE + "value", Col("value")))),
    ])
    return g.quads().select("s", "p", "o_value")


@query("typed_literal_cast", f"SELECT {iri('events')} AS e, epoch_us(ts) // 1000 AS ms, '{XSD_DATETIME}' AS datatype FROM events")
def typed_literal_cast(spark, folder):
    """Epoch milliseconds to xsd:dateTime, and the text read back as a time."""
    source = table(spark, folder, "events").select("event_id", F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("at"))
    g = MappedGraph([Mapping(source, (Rule(Template(BASE + "events/event_id={event_id}"), BASE + "at", Col("at")),), unique=True)])
    found = bgp(g, [Pattern("?e", BASE + "at", "?t")])
    return found.select("e", F.unix_millis(F.col("t.value").cast("timestamp")).alias("ms"), F.col("t.datatype").alias("datatype"))


def direct_rows(name: str, columns: dict[str, str], links: dict[str, tuple[str, str]]) -> str:
    """SQL for the direct mapping of a table: one SELECT per rule."""
    out = [f"SELECT {iri(name)} AS s, '{RDF_TYPE}' AS p, '{BASE}{name}' AS o_value, CAST(NULL AS DOUBLE) AS number FROM {name}"]
    for c, kind in columns.items():
        text = f"NULL, {c}" if kind == "double" else f"CAST({c} AS VARCHAR), NULL"
        out.append(f"SELECT {iri(name)}, '{prop(name, c)}', {text} FROM {name} WHERE {c} IS NOT NULL")
    out += [f"SELECT {iri(name)}, '{link(name, c)}', {iri(t, c, k)}, NULL FROM {name}" for c, (t, k) in links.items()]
    return " UNION ALL ".join(out)


@query("direct_mapping", " UNION ALL ".join([
    direct_rows("nation", {"n_nationkey": "int", "n_name": "text", "n_regionkey": "int"}, {"n_regionkey": ("region", "r_regionkey")}),
    direct_rows("customer", {"c_custkey": "int", "c_name": "text", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "text"}, {"c_nationkey": ("nation", "n_nationkey")}),
    direct_rows("part", {"p_partkey": "int", "p_name": "text", "p_brand": "text", "p_type": "text", "p_size": "int", "p_retailprice": "double"}, {}),
]))
def direct_mapping_query(spark, folder):
    """No mapping given: type, columns and foreign keys of three tables. Doubles are compared as numbers."""
    quads = graph(spark, folder, "nation", "customer", "part").quads()
    number = F.when(F.col("o_datatype") == XSD_DOUBLE, F.col("o_value").cast("double"))
    return quads.select("s", "p", F.when(number.isNull(), F.col("o_value")).alias("o_value"), number.alias("number"))


@query("materialize_graph", f"""
    SELECT {iri('supplier')} AS s, s_name AS o_value, 'urn:vg' AS g FROM supplier
    UNION ALL SELECT {iri('part')}, p_name, 'urn:kept' FROM part""")
def materialize_graph(spark, folder):
    """Appends one mapped source to a graph, then replaces it by another; other graphs stay."""
    def named(name, column):
        key = {"supplier": "s_suppkey", "part": "p_partkey", "customer": "c_custkey"}[name]
        rule = Rule(Template(f"{BASE}{name}/{key}={{{key}}}"), BASE + "name", Col(column))
        return MappedGraph([Mapping(table(spark, folder, name), (rule,), unique=True)])

    store = store_of(spark, named("part", "p_name").quads().withColumn("g", F.lit("urn:kept")))
    materialize(store.begin(), named("customer", "c_name"), "urn:vg").commit()
    materialize(store.begin(), named("supplier", "s_name"), "urn:vg", remove_all=True).commit()
    return store.quads().select("s", "o_value", "g")


@query("virtual_graph_view", f"SELECT '{prop('orders', 'o_orderstatus')}' AS p, o_orderstatus AS o_value, count(*) AS n FROM orders GROUP BY o_orderstatus")
def virtual_graph_view(spark, folder):
    """A mapped table as a view for SQL."""
    virtual_view(graph(spark, folder, "orders"), "virtual_orders")
    return spark.sql(
        "SELECT p, o_value, count(*) AS n FROM virtual_orders WHERE p = :p AND g = :g GROUP BY p, o_value",
        args={"p": prop("orders", "o_orderstatus"), "g": DEFAULT_GRAPH},
    )
