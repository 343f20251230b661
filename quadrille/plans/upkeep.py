"""Queries on documents, caches and compaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import Val
from ..operators.caches import CachedMatch, cached_graph, cached_query
from ..operators.documents import DocumentStore, documents, size
from ..operators.graph import Graph, Pattern
from ..operators.patterns import bgp, construct
from ..session import scratch
from .base import graph, iri, link, prop, query, status_graphs, store_of, table
from .updates import ADDED, BEFORE, REMOVED, STATUS, finished_quads, shown, status_quads, urgent_quads


def document_store(spark, folder) -> DocumentStore:
    """A new store that holds the documents."""
    store = DocumentStore(spark, scratch(spark, "documents"))
    store.put(documents(table(spark, folder, "documents"), "doc_id", "text"))
    return store


@query("doc_upsert", """
    SELECT CAST(doc_id AS VARCHAR) AS name, CASE WHEN lang = 'en' THEN 'new: ' || text ELSE text END AS text,
        CAST(strlen(text) + CASE WHEN lang = 'en' THEN 5 ELSE 0 END AS BIGINT) AS length FROM documents
    UNION ALL SELECT 'item ' || item_id, text, CAST(strlen(text) AS BIGINT) FROM benchmark""")
def doc_upsert(spark, folder):
    """New texts for the English documents, and documents that were not there before."""
    docs = table(spark, folder, "documents")
    changed = documents(docs.filter("lang = 'en'").withColumn("text", F.concat(F.lit("new: "), "text")), "doc_id", "text")
    added = documents(table(spark, folder, "benchmark").withColumn("name", F.concat(F.lit("item "), "item_id")), "name", "text")
    store = document_store(spark, folder)
    store.put(changed)
    store.put(added)
    return store.read().select("name", F.col("content").cast("string").alias("text"), "length")


@query("doc_lookup", """
    SELECT CAST(doc_id AS VARCHAR) AS name, text, count(*) OVER () AS found, (SELECT count(*) FROM documents) AS stored
    FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)""")
def doc_lookup(spark, folder):
    """Many names at once, and the size of the store."""
    store = document_store(spark, folder)
    names = table(spark, folder, "labels").filter("quality = 0").select(F.col("doc_id").cast("string").alias("name"))
    found = store.get(names).withColumn("k", F.lit(1))
    # Two one-row counts, joined on a constant key.
    counts = size(found).select(F.lit(1).alias("k"), F.col("n").alias("found")).join(store.size().select(F.lit(1).alias("k"), F.col("n").alias("stored")), "k")
    return found.join(counts, "k").select("name", F.col("content").cast("string").alias("text"), "found", "stored")


@query("doc_delete", "SELECT CAST(doc_id AS VARCHAR) AS name, CAST(strlen(text) AS BIGINT) AS length FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def doc_delete(spark, folder):
    names = table(spark, folder, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("name"))
    store = document_store(spark, folder)
    store.delete(names)
    return store.read().select("name", "length")


class Live(Graph):
    """The current state of a store, whenever it is read."""

    def __init__(self, store):
        self.store = store

    def quads(self):
        return self.store.quads()

    def match(self, pattern, nodes=frozenset(), dataset=None):
        from ..operators.graph import EVERYTHING

        return self.store.graph().match(pattern, nodes, dataset or EVERYTHING)


@query("cache_graph", f"SELECT DISTINCT {iri('customer', 'o_custkey')} AS s, o_orderpriority AS o_value, 'urn:status:F' AS g FROM orders WHERE o_orderstatus = 'F'")
def cache_graph(spark, folder):
    """A cached named graph does not follow the store until it is refreshed."""
    store = store_of(spark, status_graphs(spark, folder))
    cache = cached_graph(spark, "cache://status-f", scratch(spark, "cache"), Live(store), "urn:status:F")
    store.begin().clear("urn:status:F").commit()
    return cache.read().select("s", "o_value", "g")


@query("cache_query", "SELECT n_name AS nation, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def cache_query(spark, folder):
    g = graph(spark, folder, "customer", "nation")

    def per_nation():
        found = bgp(g, [Pattern("?c", link("customer", "c_nationkey"), "?n"), Pattern("?n", prop("nation", "n_name"), Val("?nation", "string"))])
        return found.groupBy("nation").agg(F.count("*").alias("n"))

    return cached_query(spark, "cache://nations", scratch(spark, "cache"), per_nation).read()


@query("cache_refresh", f"SELECT s, status FROM ({BEFORE} EXCEPT {REMOVED}) UNION ALL SELECT s, 'U' FROM ({ADDED})")
def cache_refresh(spark, folder):
    """Rebuilt after a commit; then a script drops a part of the cached rows and adds others."""
    store = store_of(spark, status_quads(spark, folder))
    cache = cached_graph(spark, "cache://all", scratch(spark, "cache"), Live(store))
    store.begin().add(urgent_quads(spark, folder)).commit()
    cache.refresh()
    cache.refresh(lambda old: old.filter(~((F.col("p") == STATUS) & (F.col("o_value") == "F"))))
    return cache.read().select("s", F.col("o_value").alias("status"))


@query("cache_incremental", f"""
    WITH now AS (SELECT * FROM ({BEFORE} EXCEPT {REMOVED}) UNION ALL SELECT * FROM ({ADDED})),
    p AS (SELECT {iri('orders')} AS s, o_orderpriority AS priority FROM orders)
    SELECT p.s AS s, status, priority FROM now JOIN p ON now.s = p.s""")
def cache_incremental(spark, folder):
    """Two joined patterns, cached and then kept up over two commits from their changes."""
    prio = construct(bgp(graph(spark, folder, "orders"), [Pattern("?o", prop("orders", "o_orderpriority"), "?v")]), [Pattern("?o", prop("orders", "o_orderpriority"), "?v")])
    store = store_of(spark, status_quads(spark, folder).unionByName(prio))
    patterns = [Pattern("?s", STATUS, Val("?status", "string")), Pattern("?s", prop("orders", "o_orderpriority"), Val("?priority", "string"))]
    cache = CachedMatch(spark, scratch(spark, "match"), store, patterns)
    store.begin().add(urgent_quads(spark, folder)).commit()
    cache.refresh()
    store.begin().remove(finished_quads(spark, folder)).commit()
    cache.refresh()
    return cache.read().select("s", "status", "priority")


@query("graph_compact", f"SELECT * FROM (({BEFORE}) EXCEPT ({REMOVED})) UNION ALL SELECT * FROM ({ADDED})")
def graph_compact(spark, folder):
    """Base and two deltas rewritten as a new base; the content stays the same."""
    store = store_of(spark, status_quads(spark, folder))
    store.begin().add(urgent_quads(spark, folder)).commit()
    store.begin().remove(finished_quads(spark, folder)).commit()
    store.compact()
    return shown(store.quads())

