"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, cut_measured


def _state(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a written table, with a sum that tells whether they have changed."""
    made, seen = cut_measured(edges, "stars", n=F.count(F.lit(1)), h=F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)))
    return made, (seen["n"], seen["h"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` of every node that has an edge and is not the smallest of its component; ``root`` is the smallest.

    Edges have no direction; edges to itself and repeated ones are ignored. A round hangs all larger neighbours of a node on its
    smallest one, then all smaller ones; the number of rounds grows with the logarithm of the longest chain. Each round is
    written, so plans stay short, joins can split the rows of a large star, and a lost executor costs one round.
    """
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    now, last = _state(now)
    while last[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = both.where("b > a").join(least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = cut(large, "stars")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (
            large.join(least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        )
        now, this = _state(small)
        if this == last:
            break
        last = this
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
