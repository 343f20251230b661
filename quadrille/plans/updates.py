"""Queries on set operations, updates and staged reads. Each builds its own versioned store from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import DEFAULT_GRAPH, Lit, Val
from ..operators.graph import Dataset, Pattern
from ..operators.patterns import bgp, construct, union
from .base import BASE, graph, iri, link, prop, query, status_graph, status_graphs, store_of

STATUS, PRIORITY, CUSTOMER = prop("orders", "o_orderstatus"), prop("orders", "o_orderpriority"), link("orders", "o_custkey")
URGENT = BASE + "urgent"
SPO = [Pattern("?s", "?p", "?o")]


def status_quads(spark, folder):
    """``order status`` in the default graph."""
    found = bgp(graph(spark, folder, "orders"), [Pattern("?o", STATUS, "?v")])
    return construct(found, [Pattern("?o", STATUS, "?v")])


def urgent_quads(spark, folder, graph_name: str = DEFAULT_GRAPH):
    found = bgp(graph(spark, folder, "orders"), [Pattern("?o", PRIORITY, Lit("1-URGENT"))])
    return construct(found, [Pattern("?o", STATUS, Lit("U"))], graph_name)


def finished_quads(spark, folder, graph_name: str = DEFAULT_GRAPH):
    found = bgp(graph(spark, folder, "orders"), [Pattern("?o", STATUS, Lit("F"))])
    return construct(found, [Pattern("?o", STATUS, Lit("F"))], graph_name)


def shown(quads):
    return quads.select("s", F.col("o_value").alias("status"), "g")


BEFORE = f"SELECT {iri('orders')} AS s, o_orderstatus AS status, '{DEFAULT_GRAPH}' AS g FROM orders"
ADDED = f"SELECT {iri('orders')} AS s, 'U' AS status, '{DEFAULT_GRAPH}' AS g FROM orders WHERE o_orderpriority = '1-URGENT'"
REMOVED = f"SELECT {iri('orders')} AS s, 'F' AS status, '{DEFAULT_GRAPH}' AS g FROM orders WHERE o_orderstatus = 'F'"


@query("pattern_union", f"""
    SELECT {iri('customer')} AS x, c_name AS name, {iri('nation', 'c_nationkey')} AS nation FROM customer
    UNION ALL SELECT {iri('part')}, p_name, NULL FROM part""")
def pattern_union(spark, folder):
    g = graph(spark, folder, "customer", "part")
    customers = bgp(g, [Pattern("?x", prop("customer", "c_name"), Val("?name", "string")), Pattern("?x", link("customer", "c_nationkey"), "?nation")])
    parts = bgp(g, [Pattern("?x", prop("part", "p_name"), Val("?name", "string"))])
    return union(customers.withColumn("nation", F.col("nation.value")), parts)


@query("graph_merge", f"SELECT DISTINCT {iri('customer', 'o_custkey')} AS s, '{BASE}prefers' AS p, o_orderpriority AS o_value FROM orders")
def graph_merge(spark, folder):
    """Three graphs merged as a set."""
    g = status_graph(spark, folder)
    return g.dataset_quads(Dataset.of(default=["urn:status:F", "urn:status:O", "urn:status:P"])).select("s", "p", "o_value")


@query("graph_remove", f"SELECT * FROM ({BEFORE} EXCEPT {REMOVED}) UNION ALL SELECT s, status, 'urn:copy' FROM ({BEFORE})")
def graph_remove(spark, folder):
    """Removing from the default graph leaves the copy in a named graph alone."""
    data = status_quads(spark, folder)
    store = store_of(spark, data.unionByName(data.withColumn("g", F.lit("urn:copy"))))
    store.begin().remove(finished_quads(spark, folder)).commit()
    return shown(store.quads())


@query("commit_counts", f"""
    SELECT CAST((SELECT count(*) FROM (SELECT * FROM ({ADDED}) EXCEPT SELECT * FROM ({BEFORE}))) AS BIGINT) AS added,
           CAST((SELECT count(*) FROM ({REMOVED})) AS BIGINT) AS removed""")
def commit_counts(spark, folder):
    """Triples that are there already are not counted as added, nor absent ones as removed."""
    store = store_of(spark, status_quads(spark, folder))
    batch = store.begin().add(urgent_quads(spark, folder)).add(status_quads(spark, folder))
    batch.remove(finished_quads(spark, folder)).remove(finished_quads(spark, folder, "urn:absent"))
    counts = batch.commit()
    return spark.createDataFrame([(counts["added"], counts["removed"])], "added long, removed long")


@query("insert_data", f"{BEFORE} UNION ALL SELECT s, status, 'urn:my-graph' FROM ({ADDED})")
def insert_data(spark, folder):
    store = store_of(spark, status_quads(spark, folder))
    store.begin().add(urgent_quads(spark, folder), "urn:my-graph").commit()
    return shown(store.quads())


@query("delete_data", f"SELECT s, status, 'urn:my-graph' AS g FROM ({BEFORE} EXCEPT {REMOVED})")
def delete_data(spark, folder):
    store = store_of(spark, status_quads(spark, folder).withColumn("g", F.lit("urn:my-graph")))
    store.begin().remove(finished_quads(spark, folder), "urn:my-graph").commit()
    return shown(store.quads())


@query("insert_where", f"""
    SELECT {iri('orders')} AS s, '{STATUS}' AS p, o_orderstatus AS o_value FROM orders WHERE o_orderpriority <> '1-URGENT'
    UNION ALL SELECT {iri('orders')}, '{STATUS}', o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT {iri('orders')}, '{BASE}state', o_orderstatus FROM orders
    UNION ALL SELECT {iri('orders')}, '{BASE}state', 'U' FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT {iri('orders')}, '{STATUS}', 'U' FROM orders WHERE o_orderpriority = '1-URGENT'""")
def insert_where(spark, folder):
    """USING two graphs merged; one new triple per match goes to a third graph."""
    store = store_of(spark, status_quads(spark, folder).withColumn("g", F.lit("urn:a")).unionByName(urgent_quads(spark, folder, "urn:b")))
    batch = store.begin()
    found = bgp(batch.graph(), [Pattern("?s", STATUS, "?v")], Dataset.of(default=["urn:a", "urn:b"]))
    batch.insert_where(found, [Pattern("?s", BASE + "state", "?v", "urn:c")]).commit()
    return store.quads().select("s", "p", "o_value")


@query("insert_where_named", f"SELECT DISTINCT {iri('customer', 'o_custkey')} AS s, o_orderpriority AS o_value FROM orders WHERE o_orderstatus IN ('F', 'P')")
def insert_where_named(spark, folder):
    """GRAPH ?g over two named graphs; equal triples of both become one."""
    store = store_of(spark, status_graphs(spark, folder))
    batch = store.begin()
    found = bgp(batch.graph(), [Pattern("?s", "?p", "?o", "?g")], Dataset.of(named=["urn:status:F", "urn:status:P"]))
    batch.insert_where(found, [Pattern("?s", "?p", "?o", "urn:both")]).commit()
    return bgp(store.graph(), SPO, Dataset.of(default=["urn:both"])).select("s", F.col("o.value").alias("o_value"))


@query("delete_where", f"{BEFORE} EXCEPT {REMOVED}")
def delete_where(spark, folder):
    store = store_of(spark, status_quads(spark, folder))
    batch = store.begin()
    match = [Pattern("?s", STATUS, Lit("F"))]
    batch.delete_where(bgp(batch.graph(), match), match).commit()
    return shown(store.quads())


@query("clear_graph", f"""
    SELECT DISTINCT {iri('customer', 'o_custkey')} AS s, o_orderpriority AS o_value, 'urn:status:' || o_orderstatus AS g FROM orders WHERE o_orderstatus <> 'F'""")
def clear_graph(spark, folder):
    store = store_of(spark, status_graphs(spark, folder))
    store.begin().clear("urn:status:F").commit()
    return store.quads().select("s", "o_value", "g")


@query("staged_read", f"SELECT * FROM ({BEFORE} UNION {ADDED}) EXCEPT {REMOVED}")
def staged_read(spark, folder):
    """What an open batch sees; nothing of it is written."""
    store = store_of(spark, status_quads(spark, folder))
    dropped = store.begin().clear()
    dropped.rollback()
    batch = store.begin().add(urgent_quads(spark, folder)).remove(finished_quads(spark, folder))
    return shown(batch.quads())
