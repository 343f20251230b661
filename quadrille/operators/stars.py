"""Quads by subject: one row per subject with its single-valued predicates, beside the predicate buckets of a store.

A star of patterns on one subject is then one scan and no join. Rows lie in parts by a hash of the subject, sorted by it. The
values of a row are held in ``GROUPS`` maps by a hash of the predicate, so a scan reads the maps of the predicates it asks for and not the
whole row. A predicate with two values for any subject of a graph is no column of a row; patterns on it are joined.
"""

from __future__ import annotations

import binascii
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import value_of
from ..model import Val, constant_object, is_var
from ..session import cut_measured, join_lookup
from .graph import Dataset, Graph, Pattern

GROUPS = 32
#: Values of a part, and parts at most.
VALUES, PARTS = 4_000_000, 512
EVERYTHING_CLEARED = "*"
_TERM = "struct<type:string,value:string,datatype:string,lang:string>"
_SCHEMA = "g string, s string, " + ", ".join(f"m{i} map<string,{_TERM}>" for i in range(GROUPS)) + ", s_part int"


def _part(s: Column, parts: int) -> Column:
    return F.pmod(F.crc32(s.cast("binary")), F.lit(parts)).cast("int")


def _group(p: str) -> str:
    return f"m{binascii.crc32(p.encode()) % GROUPS}"


def write_stars(quads: DataFrame, path: str) -> int:
    """Write the layout of some quads, which are a set, and return the number of parts."""
    term = F.struct(F.col("o_type").alias("type"), F.col("o_value").alias("value"), F.col("o_datatype").alias("datatype"), F.col("o_lang").alias("lang"))
    values = quads.groupBy("g", "s", "p").agg(F.min(term).alias("o"), F.count(F.lit(1)).alias("n"))
    values, seen = cut_measured(values, "values", rows=F.count(F.lit(1)))
    values.filter("n > 1").select("p").distinct().write.parquet(f"{path}/multi")
    multi = values.sparkSession.read.schema("p string").parquet(f"{path}/multi")
    parts = 1
    while parts < PARTS and parts * VALUES < seen["rows"]:
        parts *= 2
    single = join_lookup(values, multi, ["p"], "left_anti").withColumn("_m", F.pmod(F.crc32(F.col("p").cast("binary")), F.lit(GROUPS)))
    maps = [F.map_from_entries(F.collect_list(F.when(F.col("_m") == i, F.struct("p", "o")))).alias(f"m{i}") for i in range(GROUPS)]
    rows = single.groupBy("g", "s").agg(*maps).withColumn("s_part", _part(F.col("s"), parts))
    rows.hint("rebalance", F.col("s_part")).sortWithinPartitions("s_part", "s").write.partitionBy("s_part").parquet(f"{path}/rows")
    return parts


class Stars:
    """The layout at ``path``. ``later`` are the changes since it was written, with ``s`` and ``g``; ``cleared`` the graphs emptied since then."""

    def __init__(self, spark: SparkSession, path: str, parts: int, later: DataFrame | None = None, cleared: frozenset[str] = frozenset()):
        self.spark, self.path, self.parts, self.later, self.cleared = spark, path, parts, later, cleared

    def match(self, graph: Graph, patterns: list[Pattern], nodes: frozenset[str], dataset: Dataset) -> DataFrame | None:
        """Solutions of patterns with one subject and graph; None where this layout cannot tell."""
        subject, named = patterns[0].s, patterns[0].graph
        graphs = dataset.default_graphs()
        if EVERYTHING_CLEARED in self.cleared or any(is_var(p.p) for p in patterns) or (named is None and len(graphs) != 1):
            return None
        if self.later is not None and not is_var(subject):
            return None
        multi = self.spark.read.schema("p string").parquet(f"{self.path}/multi").filter(F.col("p").isin([p.p for p in patterns]))
        several = {r["p"] for r in multi.collect()}  # at most one for each pattern
        star, others = [p for p in patterns if p.p not in several], [p for p in patterns if p.p in several]
        if len(star) < 2 or (others and not is_var(subject)):
            return None
        found = self._solve(star, nodes, dataset)
        if self.later is not None:
            # Subjects that have changed are asked of the store itself.
            name = subject[1:]
            changed = self.later.select(F.col("s").alias(name)).distinct()
            kept = join_lookup(found, changed, [name], "left_anti")
            parts = [join_lookup(graph.match(p, nodes, dataset), changed, [name], "left_semi") for p in star]
            found = kept.unionByName(reduce(_natural, parts).select(*kept.columns))
        return reduce(_natural, [graph.match(p, nodes, dataset) for p in others], found)

    def _solve(self, patterns: list[Pattern], nodes: frozenset[str], dataset: Dataset) -> DataFrame:
        subject, named = patterns[0].s, patterns[0].graph
        rows = self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/rows")
        if named is None:
            rows = rows.filter(F.col("g") == dataset.default_graphs()[0])
        else:
            rows = rows.filter(dataset.named_filter(F.col("g")))
            rows = rows if is_var(named) else rows.filter(F.col("g") == named)
        if self.cleared:
            rows = rows.filter(~F.col("g").isin(sorted(self.cleared)))
        columns: dict[str, Column] = {}
        conditions: list[Column] = []

        def bind(var: str, column: Column) -> None:
            if var in columns:
                conditions.append(columns[var] == column)
            else:
                columns[var] = column

        if is_var(subject):
            bind(subject, F.col("s"))
        else:
            rows = rows.filter((F.col("s") == subject) & (F.col("s_part") == binascii.crc32(subject.encode()) % self.parts))
        if named is not None and is_var(named):
            bind(named, F.col("g"))
        for p in patterns:
            nodes = nodes | frozenset(p.node_variables)
        for p in patterns:
            o = F.col(_group(p.p))[F.lit(p.p)]
            var = p.object_var
            if var is None:
                wanted = constant_object(p.o)
                conditions += [o[field] == wanted[k] for field, k in (("type", "o_type"), ("value", "o_value"), ("datatype", "o_datatype"), ("lang", "o_lang"))]
            elif isinstance(p.o, Val):
                value = value_of(o["type"], o["value"], o["datatype"], p.o.as_type)
                conditions.append(value.isNotNull())
                bind(var, value)
            elif var in nodes:
                conditions.append(o["type"].isin("uri", "bnode"))
                bind(var, o["value"])
            else:
                conditions.append(o.isNotNull())
                bind(var, o)
        return reduce(DataFrame.filter, conditions, rows).select(*[c.alias(v[1:]) for v, c in columns.items()])


def _natural(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, [c for c in left.columns if c in right.columns])
