"""The given tables as graphs, and the register of queries over them.

Every query takes ``(spark, folder)`` and returns a DataFrame. ``sql`` is the same result in SQL over the plain tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import StoredGraph
from ..operators.mapping import MappedGraph, Table, direct_mapping
from ..operators.patterns import construct
from ..operators.store import GraphStore
from ..session import scratch, tune

BASE = "http://example.org/data/"

# Primary and foreign keys of the given tables.
KEYS = {
    "region": ("r_regionkey",), "nation": ("n_nationkey",), "customer": ("c_custkey",), "supplier": ("s_suppkey",), "part": ("p_partkey",),
    "orders": ("o_orderkey",), "lineitem": (), "events": ("event_id",), "documents": ("doc_id",), "labels": ("doc_id",), "pages": ("page_id",),
    "benchmark": ("item_id",), "conversations": ("conv_id", "turn"), "embeddings": ("vec_id",),
}
FOREIGN = {
    "nation": {"n_regionkey": ("region", "r_regionkey")},
    "customer": {"c_nationkey": ("nation", "n_nationkey")},
    "supplier": {"s_nationkey": ("nation", "n_nationkey")},
    "orders": {"o_custkey": ("customer", "c_custkey")},
    "lineitem": {"l_orderkey": ("orders", "o_orderkey"), "l_partkey": ("part", "p_partkey"), "l_suppkey": ("supplier", "s_suppkey")},
    "labels": {"doc_id": ("documents", "doc_id")},
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL when SQL can say it."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def graph(spark: SparkSession, folder: str, *names: str, columns: dict[str, list[str]] | None = None) -> MappedGraph:
    """The direct mapping of some tables."""
    tables = [Table(n, table(spark, folder, n), KEYS[n], FOREIGN.get(n, {})) for n in names]
    return direct_mapping(tables, BASE, columns)


def iri(name: str, column: str | None = None, key: str | None = None) -> str:
    """SQL text of the subject IRI of a row; ``column`` holds the key when it is not named like it."""
    key = key or KEYS[name][0]
    return f"'{BASE}{name}/{key}=' || {column or key}"


def prop(name: str, column: str) -> str:
    return f"{BASE}{name}#{column}"


def link(name: str, column: str) -> str:
    return f"{BASE}{name}#ref-{column}"


def store_of(spark: SparkSession, quads: DataFrame) -> GraphStore:
    """A new store in the shared folder."""
    return GraphStore.create(spark, scratch(spark, "store"), quads, is_set=True)


def status_graphs(spark: SparkSession, folder: str) -> DataFrame:
    """Quads ``customer prefers priority`` in one named graph per order status. A customer with orders of two
    statuses has the same triple in two graphs."""
    from ..model import Val
    from ..operators.graph import Pattern
    from ..operators.patterns import bgp

    g = graph(spark, folder, "orders")
    found = bgp(g, [
        Pattern("?o", link("orders", "o_custkey"), "?c"), Pattern("?o", prop("orders", "o_orderpriority"), "?prio"),
        Pattern("?o", prop("orders", "o_orderstatus"), Val("?status", "string")),
    ])
    named = found.select("c", "prio", F.concat(F.lit("urn:status:"), "status").alias("g"))
    return construct(named, [Pattern("?c", BASE + "prefers", "?prio", "?g")])


def status_graph(spark: SparkSession, folder: str) -> StoredGraph:
    return StoredGraph(status_graphs(spark, folder))
