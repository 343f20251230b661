"""Graphs as N-Triples and N-Quads text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import node_text, term_text
from ..model import DEFAULT_GRAPH


def triple_line() -> Column:
    obj = term_text(F.col("o_type"), F.col("o_value"), F.col("o_datatype"), F.col("o_lang"))
    return F.concat_ws(" ", node_text(F.col("s")), node_text(F.col("p")), obj, F.lit("."))


def quad_line() -> Column:
    """The default graph is left out, as the format has no name for it."""
    obj = term_text(F.col("o_type"), F.col("o_value"), F.col("o_datatype"), F.col("o_lang"))
    graph = F.when(F.col("g") != DEFAULT_GRAPH, node_text(F.col("g")))
    return F.concat_ws(" ", node_text(F.col("s")), node_text(F.col("p")), obj, graph, F.lit("."))


def write_ntriples(quads: DataFrame, path: str, graph: str = DEFAULT_GRAPH, compression: str = "none") -> None:
    """Export one graph: the default graph without the named ones, or one named graph alone."""
    quads.filter(F.col("g") == graph).select(triple_line().alias("value")).write.option("compression", compression).text(path)


def write_nquads(quads: DataFrame, path: str, compression: str = "none") -> None:
    """Export all graphs."""
    quads.select(quad_line().alias("value")).write.option("compression", compression).text(path)
