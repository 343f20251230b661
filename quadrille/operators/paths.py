"""Paths over edges ``(src, via, dst)``: reachability and shortest paths.

Both run level by level on numbers instead of text. Reachability holds a node once, with a set of bits that says from which starts it is
reached, however many starts there are. Shortest paths are searched from both ends, and the end with the smaller frontier goes on, until
the frontiers meet. The frontier of a level is broadcast when its measured size allows it, which leaves the edges unshuffled; beyond
that both sides are shuffled and adaptive execution splits hot nodes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_BYTES, cut, cut_measured
from .graph import EVERYTHING, Dataset, Graph, Pattern
from .numbers import Numbered

#: Starts that share a row of a node: a bit each, in words of 64.
STARTS, WORD = 1024, 64


def edges_of(graph: Graph, predicate: str | None = None, dataset: Dataset = EVERYTHING) -> DataFrame:
    """Edges of a graph: all links between nodes, or those of one predicate."""
    p = "?via" if predicate is None else predicate
    found = graph.match(Pattern("?src", p, "?dst"), frozenset(["?dst"]), dataset)
    via = F.col("via") if predicate is None else F.lit(predicate).alias("via")
    return found.select("src", via, "dst")


def _step(frontier: DataFrame, size: int, edges: DataFrame, on: str) -> DataFrame:
    """Edges that meet a frontier of ``size`` measured bytes."""
    return edges.join(F.broadcast(frontier) if size <= BROADCAST_BYTES else frontier, on)


def _levels(starts: DataFrame) -> tuple[DataFrame, int]:
    """``starts`` numbered from 0 without gaps inside a share of rows: ``start, share, word, bit``, and how many words a share has."""
    placed, seen = cut_measured(starts.withColumn("_id", F.monotonically_increasing_id()), "starts", most=F.coalesce(F.max(F.col("_id").bitwiseAND((1 << 33) - 1)), F.lit(0)))
    inside = F.col("_id").bitwiseAND((1 << 33) - 1)
    words = min(STARTS // WORD, seen["most"] // WORD + 1)
    share = F.struct(F.shiftright("_id", 33).alias("part"), F.floor(inside / STARTS).alias("n"))
    return placed.select("*", F.xxhash64(share).alias("share"), F.floor(inside % STARTS / WORD).cast("int").alias("word"), (inside % WORD).cast("int").alias("bit")), words


def reachable(edges: DataFrame, starts: DataFrame, include_start: bool = False, max_length: int | None = None) -> DataFrame:
    """Pairs ``(start, node)`` with a path of one or more edges (``p+``); with ``include_start`` also none (``p*``).

    ``starts`` has one column ``start``: pairs of all nodes of a large graph are nobody's wish, so it must be given. A node is held once
    for up to ``STARTS`` starts. A level passes on only the bits that are new, so cycles end.
    """
    graph = Numbered(edges, ["src", "dst"], distinct=False)
    starts = cut(starts.select("start").filter(F.col("start").isNotNull()).distinct(), "asked")
    itself = starts.select("start", F.col("start").alias("node"))
    placed, words = _levels(graph.known(starts, "start"))
    names = [f"w{i}" for i in range(words)]
    key = ["share", "node"]

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*key).agg(*[F.bit_or(w).alias(w) for w in names])

    def bits(i: int) -> Column:
        return F.when(F.col("word") == i, F.expr("shiftleft(1L, bit)")).otherwise(F.lit(0).cast("long")).alias(f"w{i}")

    first = merged(placed.select("share", F.col("id").alias("node"), *[bits(i) for i in range(words)]))
    frontier, measured = cut_measured(first, "frontier")
    found: list[DataFrame] = []
    length = 0
    while measured["bytes"] and (max_length is None or length < max_length):
        reached = merged(_step(frontier.withColumnRenamed("node", "src"), measured["bytes"], graph.rows, "src").select("share", F.col("dst").alias("node"), *names))
        if found:
            seen = merged(reduce(DataFrame.unionByName, found)).select(*key, *[F.col(w).alias(f"_{w}") for w in names])
            reached = reached.join(seen, key, "left").select(*key, *[F.col(w).bitwiseAND(F.bitwise_not(F.coalesce(F.col(f"_{w}"), F.lit(0)))).alias(w) for w in names])
            reached = reached.filter(reduce(Column.__or__, [F.col(w) != 0 for w in names]))
        frontier, measured = cut_measured(reached, "frontier")
        if measured["bytes"]:
            found.append(frontier)
        length += 1
    if not found:
        return itself if include_start else itself.limit(0)
    # Bits as rows again: the words that are not empty, then the bits of a word that are set.
    sets = F.filter(F.array(*[F.struct(F.lit(i).alias("word"), F.col(w).alias("bits")) for i, w in enumerate(names)]), lambda x: x["bits"] != 0)
    rows = reduce(DataFrame.unionByName, found).select(*key, F.inline(sets))
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit("bits", i) == 1))
    pairs = rows.select(*key, "word", bit.alias("bit")).join(placed.select("share", "word", "bit", "start"), ["share", "word", "bit"])
    every = graph.text(pairs.select("start", "node"), "node").select("start", "node")
    return every.unionByName(itself).distinct() if include_start else every


class _Side:
    """One end of a search: the levels found from it, and where the next one comes from."""

    def __init__(self, edges: DataFrame, here: str, there: str, node: DataFrame):
        self.edges, self.here, self.there = edges, here, there
        self.levels, self.seen, self.rows, self.bytes = [node], node, 1, 0

    def widen(self, other: DataFrame) -> bool:
        """Find the next level; whether it meets the last one of the other end."""
        reached = _step(self.levels[-1].withColumnRenamed("node", self.here), self.bytes, self.edges, self.here).select(F.col(self.there).alias("node")).distinct()
        reached = reached.join(self.seen, "node", "left_anti").join(other.withColumn("_met", F.lit(1)), "node", "left")
        level, seen = cut_measured(reached, "level", n=F.count(F.lit(1)), met=F.count("_met"))
        self.rows, self.bytes = seen["n"], seen["bytes"]
        level = level.select("node")
        self.levels.append(level)
        self.seen = self.seen.unionByName(level)
        return seen["met"] > 0


def shortest_paths(edges: DataFrame, start: str, end: str, max_length: int | None = None) -> DataFrame:
    """All shortest paths from ``start`` to ``end``, one row each: ``length`` and ``hops``, an array of
    ``(src, via, dst)`` in order. No row when ``end`` is not reached, is ``start`` itself, or is not within ``max_length`` edges.

    Levels grow from both ends. As long as no node is in a level of either end, the shortest path is longer than the levels
    together, so the first meeting is between the newest levels. From the nodes in which they meet, only edges between neighbouring levels are
    kept. Paths are then spelled out on those edges alone, so no partial path that misses an end is built.
    """
    spark = edges.sparkSession
    schema = "length int, hops array<struct<src:string,via:string,dst:string>>"
    graph = Numbered(edges, ["src", "via", "dst"])
    links = graph.rows.select("src", "dst")
    ends = graph.known(spark.createDataFrame([(start, 0), (end, 1)], "name string, side int"), "name").collect()
    numbers = {r["side"]: r["id"] for r in ends}
    if start == end or len(numbers) < 2:
        return spark.createDataFrame([], schema)
    one = [spark.createDataFrame([(numbers[k],)], "node long") for k in (0, 1)]
    ahead, back = _Side(links, "src", "dst", one[0]), _Side(links, "dst", "src", one[1])
    met = False
    while not met and ahead.rows and back.rows and (max_length is None or len(ahead.levels) + len(back.levels) - 2 < max_length):
        met = ahead.widen(back.levels[-1]) if ahead.rows <= back.rows else back.widen(ahead.levels[-1])
    if not met:
        return spark.createDataFrame([], schema)
    middle, seen = cut_measured(ahead.levels[-1].join(back.levels[-1], "node", "left_semi"), "middle")

    def kept(levels: list[DataFrame], here: str, there: str) -> list[DataFrame]:
        """Edges from the middle to an end, level by level."""
        parts, wanted, size = [], middle, seen["bytes"]
        for nodes in reversed(levels[:-1]):
            useful = _step(wanted.withColumnRenamed("node", there), size, graph.rows, there)
            useful, measured = cut_measured(useful.join(nodes.withColumnRenamed("node", here), here, "left_semi").select("src", "via", "dst"), "kept")
            parts.append(useful)
            # The nodes wanted next are part of these edges, so their size is bounded by it.
            wanted, size = useful.select(F.col(here).alias("node")).distinct(), measured["bytes"]
        return parts

    steps = [*reversed(kept(ahead.levels, "src", "dst")), *kept(back.levels, "dst", "src")]
    hop = F.struct("src", "via", "dst")
    paths = None
    for part in steps:
        named = graph.text(part.select("*", F.col("src").alias("_from"), F.col("dst").alias("_to")), "src", "via", "dst").select("_from", "_to", hop.alias("_hop"))
        if paths is None:
            paths = named.select(F.array("_hop").alias("hops"), F.col("_to").alias("_at"))
        else:
            nxt = named.withColumnRenamed("_from", "_at")
            paths = paths.join(nxt, "_at").select(F.array_append("hops", F.col("_hop")).alias("hops"), F.col("_to").alias("_at"))
    return paths.select(F.lit(len(steps)).alias("length"), "hops")
