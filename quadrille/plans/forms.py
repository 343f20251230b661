"""Queries on query forms: ask, construct, paths, reachability and nested objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.iri import Template
from ..model import DEFAULT_GRAPH, Lit, Val
from ..operators.graph import Pattern
from ..operators.mapping import MappedGraph, Mapping, Rule
from ..operators.nested import Field, nest, select_fields, select_nested
from ..operators.paths import edges_of, reachable, shortest_paths
from ..operators.patterns import ask, bgp, construct
from .base import BASE, graph, iri, link, prop, query, store_of, table

PRICE, CUSTOMER, SEGMENT = prop("orders", "o_totalprice"), link("orders", "o_custkey"), prop("customer", "c_mktsegment")


@query("ask", """
    SELECT EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 400000 AND c_mktsegment = 'BUILDING') AS answer""")
def ask_query(spark, folder):
    found = bgp(graph(spark, folder, "orders", "customer"), [
        Pattern("?o", PRICE, Val("?price")), Pattern("?o", CUSTOMER, "?c"), Pattern("?c", SEGMENT, Lit("BUILDING")),
    ])
    return ask(found.filter("price > 400000"))


@query("construct", f"""
    SELECT DISTINCT {iri('customer')} AS s, '{BASE}livesIn' AS p, {iri('region', 'n_regionkey')} AS o_value FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT DISTINCT {iri('region', 'n_regionkey')}, '{BASE}hasSegment', c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def construct_query(spark, folder):
    """Two triples per match, as a set; the second one repeats for most matches. A literal subject makes no triple."""
    found = bgp(graph(spark, folder, "customer", "nation"), [
        Pattern("?c", link("customer", "c_nationkey"), "?n"), Pattern("?c", SEGMENT, "?seg"), Pattern("?n", link("nation", "n_regionkey"), "?r"),
    ])
    made = construct(found, [
        Pattern("?c", BASE + "livesIn", "?r"), Pattern("?r", BASE + "hasSegment", "?seg"), Pattern("?seg", BASE + "of", "?r"),
    ])
    return made.select("s", "p", "o_value")


def trade_graph(spark, folder) -> MappedGraph:
    """A cyclic graph: order -> customer -> nation -> supplier -> part -> order."""
    order, cust, nation, supp, part = (
        Template(BASE + t) for t in (
            "orders/o_orderkey={o_orderkey}", "customer/c_custkey={c_custkey}", "nation/n_nationkey={s_nationkey}", "supplier/s_suppkey={l_suppkey}",
            "part/p_partkey={l_partkey}",
        )
    )
    orders, customers, suppliers, lines = (table(spark, folder, t) for t in ("orders", "customer", "supplier", "lineitem"))
    return MappedGraph([
        Mapping(orders, (Rule(order, BASE + "by", Template(BASE + "customer/c_custkey={o_custkey}")),), unique=True),
        Mapping(customers, (Rule(cust, BASE + "in", Template(BASE + "nation/n_nationkey={c_nationkey}")),), unique=True),
        Mapping(suppliers, (Rule(nation, BASE + "hosts", Template(BASE + "supplier/s_suppkey={s_suppkey}")),)),
        Mapping(lines, (Rule(supp, BASE + "sells", part),)),
        Mapping(lines, (Rule(part, BASE + "partOf", Template(BASE + "orders/o_orderkey={l_orderkey}")),)),
    ])


TRADE = f"""
    edges AS MATERIALIZED (
        SELECT {iri('orders')} AS src, 'by' AS via, {iri('customer', 'o_custkey')} AS dst FROM orders
        UNION ALL SELECT {iri('customer')}, 'in', {iri('nation', 'c_nationkey')} FROM customer
        UNION ALL SELECT {iri('nation', 's_nationkey')}, 'hosts', {iri('supplier')} FROM supplier
        UNION ALL SELECT DISTINCT {iri('supplier', 'l_suppkey')}, 'sells', {iri('part', 'l_partkey')} FROM lineitem
        UNION ALL SELECT DISTINCT {iri('part', 'l_partkey')}, 'partOf', {iri('orders', 'l_orderkey')} FROM lineitem)"""
START, END = BASE + "supplier/s_suppkey=0", BASE + "nation/n_nationkey=3"


@query("paths_shortest", f"""
    WITH RECURSIVE {TRADE},
    steps AS (SELECT '{START}' AS node, 0 AS d UNION SELECT e.dst, s.d + 1 FROM steps s JOIN edges e ON e.src = s.node WHERE s.d < 9),
    levels AS MATERIALIZED (SELECT node, min(d) AS d FROM steps GROUP BY node),
    walks AS (
        SELECT '{END}' AS node, '' AS path, (SELECT d FROM levels WHERE node = '{END}') AS d
        UNION ALL
        SELECT e.src, e.via || '>' || e.dst || ' ' || w.path, w.d - 1 FROM walks w JOIN edges e ON e.dst = w.node JOIN levels l ON l.node = e.src AND l.d = w.d - 1 WHERE w.d > 0)
    SELECT CAST((SELECT d FROM levels WHERE node = '{END}') AS INTEGER) AS length, path FROM walks WHERE d = 0""")
def paths_shortest(spark, folder):
    """All shortest ways from a supplier to a nation its parts are ordered from, over the cyclic trade graph."""
    found = shortest_paths(edges_of(trade_graph(spark, folder)), START, END)
    hop = F.transform("hops", lambda h: F.concat(F.replace(h["via"], F.lit(BASE), F.lit("")), F.lit(">"), h["dst"], F.lit(" ")))
    return found.select("length", F.array_join(hop, "").alias("path"))


@query("path_reachable", f"""
    WITH RECURSIVE {TRADE},
    reached AS (SELECT dst AS node FROM edges WHERE src = '{START}' UNION SELECT e.dst FROM reached r JOIN edges e ON e.src = r.node)
    SELECT '{START}' AS start, node FROM reached""")
def path_reachable(spark, folder):
    """Everything reached from one supplier by one or more edges of the cyclic trade graph."""
    start = spark.createDataFrame([(START,)], "start string")
    return reachable(edges_of(trade_graph(spark, folder)), start)


@query("stored_reachable", f"""
    WITH pairs AS (SELECT DISTINCT {iri('nation', 's_nationkey')} AS nation, {iri('supplier')} AS supplier, {iri('part', 'l_partkey')} AS part
        FROM supplier JOIN lineitem ON l_suppkey = s_suppkey)
    SELECT {iri('nation', 's_nationkey')} AS start, {iri('supplier')} AS node FROM supplier UNION SELECT nation, part FROM pairs
    UNION ALL SELECT DISTINCT supplier, part FROM pairs""")
def stored_reachable(spark, folder):
    """From every nation and every supplier of a stored graph: what is hosted, and what that sells. All starts share the rows of a node."""
    stored = store_of(spark, trade_graph(spark, folder).statements([BASE + "hosts", BASE + "sells"]).select(
        "s", "p", F.col("o.value").alias("o_value"), F.col("o.type").alias("o_type"), F.lit("").alias("o_datatype"), F.lit("").alias("o_lang"), F.lit(DEFAULT_GRAPH).alias("g")))
    edges = edges_of(stored.graph())
    return reachable(edges, edges.select(F.col("src").alias("start")).distinct())


@query("nested_children", f"""
    WITH n AS (SELECT 'r_regionkey=' || n_regionkey AS region, 'n_nationkey=' || n_nationkey AS nation, n_nationkey AS k FROM nation),
    c AS (SELECT nation, 'c_custkey=' || c_custkey AS customer, c_name, c_mktsegment FROM customer JOIN n ON c_nationkey = k),
    s AS (SELECT nation, 's_suppkey=' || s_suppkey AS supplier FROM supplier JOIN n ON s_nationkey = k)
    SELECT 'name' AS path, 'r_regionkey=' || r_regionkey AS of, 0 AS position, r_name AS value FROM region
    UNION ALL SELECT 'nations', region, row_number() OVER (PARTITION BY region ORDER BY nation) - 1, nation FROM n
    UNION ALL SELECT 'nations/customers', nation, row_number() OVER (PARTITION BY nation ORDER BY customer) - 1, customer FROM c
    UNION ALL SELECT 'nations/suppliers', nation, row_number() OVER (PARTITION BY nation ORDER BY supplier) - 1, supplier FROM s
    UNION ALL SELECT 'nations/customers/name', customer, 0, c_name FROM c
    UNION ALL SELECT 'nations/customers/segment', customer, 0, c_mktsegment FROM c""")
def nested_children(spark, folder):
    """Regions with their nations, these with two lists, and the elements of one of them with fields of their own."""
    g = graph(spark, folder, "region", "nation", "customer", "supplier")
    customers = Field("customers", link("customer", "c_nationkey"), (Field("name", prop("customer", "c_name")), Field("segment", SEGMENT)), inverse=True)
    nations = Field("nations", link("nation", "n_regionkey"), (customers, Field("suppliers", link("supplier", "s_nationkey"), inverse=True)), inverse=True)
    return select_nested(g, BASE + "region", [Field("name", prop("region", "r_name")), nations]).flat()


@query("nested_select", f"SELECT {iri('customer')} AS id, c_name AS name, 'n_nationkey=' || c_nationkey AS nation FROM customer")
def nested_select(spark, folder):
    """Fields of a class: a literal by its text, a link by its local name."""
    g = graph(spark, folder, "customer")
    return select_fields(g, BASE + "customer", [Field("name", prop("customer", "c_name")), Field("nation", link("customer", "c_nationkey"))])


@query("nested_arg_filter", "SELECT c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING'")
def nested_arg_filter(spark, folder):
    """An equality argument given as a variable."""
    variables = {"segment": Lit("BUILDING")}
    found = select_fields(graph(spark, folder, "customer"), BASE + "customer", [Field("name", prop("customer", "c_name"))], {SEGMENT: variables["segment"]})
    return found.select("name")


@query("nested_list_field", f"""
    SELECT n_name AS nation, c_name AS name, c_mktsegment AS segment, row_number() OVER (PARTITION BY n_name ORDER BY c_name, c_mktsegment) - 1 AS position
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def nested_list_field(spark, folder):
    """Nations with the list of their customers, an element a row."""
    g = graph(spark, folder, "customer", "nation")
    found = bgp(g, [
        Pattern("?c", link("customer", "c_nationkey"), "?n"), Pattern("?c", prop("customer", "c_name"), Val("?name", "string")),
        Pattern("?c", SEGMENT, Val("?segment", "string")), Pattern("?n", prop("nation", "n_name"), Val("?nation", "string")),
    ])
    return nest(found, ["nation"], ["name", "segment"])
