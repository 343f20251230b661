"""Materialised graphs and query results.

A cache is a folder of numbered versions and keeps how it is made. A refresh writes the next version beside the one in
use and publishes it afterwards, so readers never see half of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import DEFAULT_GRAPH, QUAD, as_set
from ..session import create_once, cut
from .graph import Dataset, Graph, Pattern, StoredGraph
from .mapping import MappedGraph
from .patterns import bgp
from .store import Batch, GraphStore

#: How often a cached solution occurs.
COUNT = "_count"


class Cache:
    """A cache in a folder. ``make`` builds the content from the current state of its source each time it is called.

    Any session may open the folder again; what is current is read from it, and nothing is kept in memory. A cache that is
    opened only to be read needs no ``make``.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, make: Callable[[], DataFrame] | None = None, register_only: bool = False):
        self.spark, self.name, self.folder, self.make = spark, name, folder.rstrip("/"), make
        if make is not None and not register_only and self.version() == 0:
            self.refresh()

    def refresh(self, script: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Rebuild; with ``script`` the new content is made from the cached one instead. Of two refreshes at once one fails."""
        version = self.version() + 1
        content = self._made() if script is None else script(self.read())
        data = f"data-{version}-{uuid.uuid4().hex[:12]}"
        content.write.parquet(f"{self.folder}/{data}")
        create_once(self.spark, f"{self.folder}/versions/{version}.json", {"version": version, "data": data, "schema": content.schema.json()})

    def _made(self) -> DataFrame:
        if self.make is None:
            raise ValueError(f"cache {self.name} has been opened without its definition")
        return self.make()

    def _current(self):
        try:
            found = self.spark.read.schema("version long, data string, schema string").json(f"{self.folder}/versions")
            return found.orderBy(F.desc("version")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def version(self) -> int:
        """The version in use, 0 before the first."""
        now = self._current()
        return now["version"] if now else 0

    def read(self) -> DataFrame:
        """The cached rows; a cache that was only registered is read through its definition."""
        now = self._current()
        if now is None:
            return self._made()
        schema = T.StructType.fromJson(json.loads(now["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{now['data']}")


def cached_graph(spark: SparkSession, name: str, folder: str, graph: Graph, named: str | None = None, register_only: bool = False) -> Cache:
    """Materialise one named graph, or a whole graph such as a mapped one."""

    def make():
        quads = graph.quads()
        return quads if named is None else quads.filter(F.col("g") == named)

    return Cache(spark, name, folder, make, register_only)


def cached_query(spark: SparkSession, name: str, folder: str, query: Callable[[], DataFrame], register_only: bool = False) -> Cache:
    return Cache(spark, name, folder, query, register_only)


class CachedMatch:
    """The solutions of patterns on a store, kept up from what has changed.

    Each solution is stored once with how often it occurs, so that a removal takes away as many as it should. After a commit only the changes of
    each pattern are joined with the other patterns, those before it as they are now and those after it as they were; a single pattern
    reads nothing but the changes and the cached rows. Where the deltas do not tell (see ``GraphStore.changes_since``) it is made anew.
    """

    def __init__(self, spark: SparkSession, folder: str, store: GraphStore, patterns: list[Pattern]):
        self.spark, self.folder, self.store, self.patterns = spark, folder.rstrip("/"), store, list(patterns)
        self.nodes = frozenset(v for p in self.patterns for v in p.node_variables)
        self.columns = list(dict.fromkeys(v[1:] for p in self.patterns for v in p.variables))
        if self._current() is None:
            self._write(0, self._counted(bgp(store.graph(), self.patterns)), store._record())

    def _current(self) -> dict | None:
        try:
            found = self.spark.read.schema("version long, data string, schema string, record string").json(f"{self.folder}/versions").orderBy(F.desc("version")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return found.asDict() if found else None

    def _counted(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.columns).agg(F.count(F.lit(1)).alias(COUNT))

    def _write(self, version: int, rows: DataFrame, record: dict) -> None:
        data = f"data-{version + 1}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.folder}/{data}")
        known = {"version": version + 1, "data": data, "schema": rows.schema.json(), "record": json.dumps({k: record[k] for k in ("base", "deltas", "folds")})}
        create_once(self.spark, f"{self.folder}/versions/{version + 1}.json", known)

    def _rows(self, now: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(now["schema"]))).parquet(f"{self.folder}/{now['data']}")

    def read(self) -> DataFrame:
        """The cached solutions as a bag."""
        rows = self._rows(self._current())
        return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(COUNT)))).drop(COUNT, "_copy")

    def refresh(self) -> bool:
        """Bring the rows up to the newest version of the store; whether the changes were enough for that."""
        now, record = self._current(), self.store._record()
        rows = self._changed(now)
        self._write(now["version"], self._counted(bgp(self.store.graph(), self.patterns)) if rows is None else rows, record)
        return rows is not None

    def _changed(self, now: dict) -> DataFrame | None:
        """The cached rows with the changes; None where these are not known."""
        old = json.loads(now["record"])
        changes = self.store.changes_since(old)
        if changes is None:
            return None
        before, after = StoredGraph(self.store._read(old)), self.store.graph()
        parts = [self._rows(now)]
        for sign, quads in zip((1, -1), changes):
            changed = StoredGraph(cut(quads, "changes"))
            for i, pattern in enumerate(self.patterns):
                others = [(after, p) for p in self.patterns[:i]] + [(before, p) for p in self.patterns[i + 1:]]
                found = self._joined(changed.match(pattern, self.nodes), others)
                parts.append(found.select(*self.columns, F.lit(sign).cast("long").alias(COUNT)))
        total = reduce(DataFrame.unionByName, parts).groupBy(*self.columns).agg(F.sum(COUNT).alias(COUNT))
        return total.filter(F.col(COUNT) > 0)

    def _joined(self, found: DataFrame, others: list[tuple[Graph, Pattern]]) -> DataFrame:
        """Changes joined with the other patterns, always one that shares a variable with what is there."""
        while others:
            graph, pattern = next((g, p) for g, p in others if {v[1:] for v in p.variables} & set(found.columns))
            more = graph.match(pattern, self.nodes)
            found = found.join(more, [c for c in found.columns if c in more.columns])
            others = [(g, p) for g, p in others if p is not pattern]
        return found


def materialize(batch: Batch, mapped: MappedGraph, graph: str = DEFAULT_GRAPH, remove_all: bool = False) -> Batch:
    """Stage the triples of a mapped source in ``graph``: appended to what is there, or in its place."""
    if remove_all:
        batch.clear(graph)
    return batch.add(mapped.quads(), graph)


def virtual_view(mapped: Graph, name: str, dataset: Dataset | None = None) -> DataFrame:
    """A mapped source as a named temporary view of quads; renaming and dropping are the catalog's own functions."""
    df = mapped.quads() if dataset is None else mapped.dataset_quads(dataset)
    df.createOrReplaceTempView(name)
    return df


def bulk_quads(*sources: tuple[DataFrame, str]) -> DataFrame:
    """Quads of several sources, each put into its graph, as one set."""
    parts = [df.withColumn("g", F.lit(graph)).select(*QUAD) for df, graph in sources]
    return as_set(reduce(DataFrame.unionByName, parts))
