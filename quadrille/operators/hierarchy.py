"""Intervals for hierarchies: what lies below a name, without the closure.

Every name is a node of a spanning tree and has the place of the node in pre-order and the last place below it; places count
within a tree, so trees are numbered apart. A name is below another if its place lies in the other's interval. Edges that are in no
tree, those of further parents and those that close cycles, carry the interval of their lower end up to their upper end: where that lies in an
interval, the lower end's interval belongs to the answer too.

Trees are built level by level, places with one pass up and one down; each level is a table of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, cut_measured


class Hierarchy:
    """``nodes``: ``(name, tree, first, last)``; ``extra``: intervals of lower ends and the place of the upper end, one row per edge in no tree."""

    def __init__(self, edges: DataFrame):
        """``edges`` are ``(sub, super)``; cycles and several parents may occur, and an edge from a name to itself says nothing."""
        self.spark = edges.sparkSession
        edges = cut(edges.select("sub", "super").filter("sub IS NOT NULL AND super IS NOT NULL AND sub <> super").distinct(), "edges")
        levels = self._levels(edges)
        self.nodes = self._placed(levels)
        self._extras = 0
        if not levels:  # no edges
            return
        tree = reduce(DataFrame.unionByName, levels).filter("parent IS NOT NULL").select(F.col("name").alias("sub"), F.col("parent").alias("super"))
        low = self.nodes.select(F.col("name").alias("sub"), "tree", "first", "last")
        up = self.nodes.select(F.col("name").alias("super"), F.col("tree").alias("up_tree"), F.col("first").alias("up_place"))
        extra = edges.join(tree, ["sub", "super"], "left_anti").join(low, "sub").join(up, "super").drop("sub", "super")
        self.extra, seen = cut_measured(extra, "extra", n=F.count(F.lit(1)))
        self._extras = seen["n"]

    def _levels(self, edges: DataFrame) -> list[DataFrame]:
        """``(name, parent, tree)`` per level. A tree is named by its root."""
        names = edges.select(F.col("sub").alias("name")).unionByName(edges.select(F.col("super").alias("name"))).distinct()
        roots = names.join(edges.select(F.col("sub").alias("name")), "name", "left_anti")
        levels: list[DataFrame] = []
        self._grow(roots, edges, levels)
        # What is left is on or below cycles. There, names without a smaller one above them become roots.
        left, seen = cut_measured(names.join(self._known(levels), "name", "left_anti") if levels else names, "left", n=F.count(F.lit(1)))
        if seen["n"]:
            inside = cut(edges.join(left.withColumnRenamed("name", "sub"), "sub", "left_semi").join(left.withColumnRenamed("name", "super"), "super", "left_semi"), "inside")
            least, changed = left.withColumn("least", F.col("name")), 1
            while changed:
                above = inside.join(least.withColumnRenamed("name", "super"), "super").groupBy(F.col("sub").alias("name")).agg(F.min("least").alias("above"))
                least, seen = cut_measured(
                    least.join(above, "name", "left").select("name", F.least("least", "above").alias("least"), (F.col("above") < F.col("least")).alias("moved")), "least",
                    n=F.coalesce(F.sum(F.col("moved").cast("int")), F.lit(0)))
                least, changed = least.drop("moved"), seen["n"]
            self._grow(least.filter("name = least").select("name"), edges, levels)
        return levels

    def _known(self, levels: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, levels).select("name")

    def _grow(self, roots: DataFrame, edges: DataFrame, levels: list[DataFrame]) -> None:
        """Add the trees below ``roots``, a level after the other; of several parents in a level the smallest is the one of the tree."""
        found, seen = cut_measured(roots.select("name", F.lit(None).cast("string").alias("parent"), F.col("name").alias("tree")), "level", n=F.count(F.lit(1)))
        depth = 0
        while seen["n"]:
            if depth < len(levels):
                levels[depth] = levels[depth].unionByName(found)
            else:
                levels.append(found)
            below = edges.join(found.select(F.col("name").alias("super"), "tree"), "super").groupBy(F.col("sub").alias("name")).agg(
                F.min(F.struct(F.col("super"), F.col("tree"))).alias("up")).select("name", F.col("up.super").alias("parent"), F.col("up.tree").alias("tree"))
            found, seen = cut_measured(below.join(self._known(levels), "name", "left_anti"), "level", n=F.count(F.lit(1)))
            depth += 1

    def _placed(self, levels: list[DataFrame]) -> DataFrame:
        """Sizes of subtrees from the lowest level up, then places from the roots down."""
        if not levels:
            return self.spark.createDataFrame([], "name string, tree string, first long, last long")
        sized: list[DataFrame] = []
        for level in reversed(levels):
            now = level.withColumn("size", F.lit(1).cast("long"))
            if sized:
                below = sized[-1].groupBy(F.col("parent").alias("name")).agg(F.sum("size").alias("more"))
                now = level.join(below, "name", "left").select("name", "parent", "tree", (1 + F.coalesce("more", F.lit(0))).alias("size"))
            sized.append(cut(now, "sizes"))
        sized.reverse()
        before = Window.partitionBy("parent").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
        placed = [sized[0].select("name", "tree", F.lit(0).cast("long").alias("first"), "size")]
        for level in sized[1:]:
            up = placed[-1].select(F.col("name").alias("parent"), F.col("first").alias("up"))
            inner = level.filter("parent IS NOT NULL").join(up, "parent").withColumn("first", F.col("up") + 1 + F.coalesce(F.sum("size").over(before), F.lit(0)))
            placed.append(cut(inner.select("name", "tree", "first", "size"), "places"))
        every = reduce(DataFrame.unionByName, placed)
        return cut(every.select("name", "tree", "first", (F.col("first") + F.col("size") - 1).alias("last")), "intervals")

    def below(self, names: DataFrame) -> DataFrame:
        """``(name, below)``: for every given ``name``, itself and all names below it, on cycles too.

        Intervals are found by the edges that are in no tree: one step per such edge on a way down, and none in a tree.
        """
        asked = names.select("name").distinct()
        found = cut(asked.join(self.nodes, "name").select("name", "tree", "first", "last"), "asked")
        new, more = found, self._extras
        while more:
            inside = self.extra.join(
                new.select("name", F.col("tree").alias("_tree"), F.col("first").alias("_first"), F.col("last").alias("_last")),
                (F.col("up_tree") == F.col("_tree")) & F.col("up_place").between(F.col("_first"), F.col("_last")))
            reached = inside.select("name", "tree", "first", "last").distinct()
            held = found.select(F.col("name").alias("_name"), F.col("tree").alias("_tree"), F.col("first").alias("_first"), F.col("last").alias("_last"))
            covered = (F.col("name") == F.col("_name")) & (F.col("tree") == F.col("_tree")) & (F.col("first") >= F.col("_first")) & (F.col("last") <= F.col("_last"))
            new, seen = cut_measured(reached.join(held, covered, "left_anti"), "reached", n=F.count(F.lit(1)))
            found, more = found.unionByName(new), seen["n"]
        held = found.select("name", F.col("tree").alias("_tree"), F.col("first").alias("_first"), F.col("last").alias("_last"))
        inside = self.nodes.withColumnRenamed("name", "below").join(held, (F.col("tree") == F.col("_tree")) & F.col("first").between(F.col("_first"), F.col("_last")))
        return inside.select("name", "below").unionByName(asked.select("name", F.col("name").alias("below"))).distinct()
