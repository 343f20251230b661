"""Flat RDF/XML: one level of ``rdf:Description``, one triple per child element."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import DEFAULT_GRAPH, QUAD


def read_rdfxml_flat(spark: SparkSession, path: str | list[str], prefixes: dict[str, str], elements: list[str] | None = None,
                     graph: str = DEFAULT_GRAPH, row_tag: str = "rdf:Description") -> DataFrame:
    """Quads of flat descriptions.

    ``elements`` are the qualified names of the children to read (``a:title``) and ``prefixes`` their namespaces. Without
    ``elements`` all children are read, whose names one more pass over the files collects. A child with a ``resource`` attribute links to an IRI, any
    other is a literal with optional datatype and language. A description without ``rdf:about`` is a blank node named
    by its place in the input.
    """
    # Attribute and text columns as the XML reader names them.
    attributes = ["_VALUE", "_resource", "_rdf:resource", "_rdf:datatype", "_xml:lang"]
    child = T.ArrayType(T.StructType([T.StructField(a, T.StringType()) for a in attributes]))
    if elements is None:
        found = spark.read.format("xml").option("rowTag", row_tag).option("inferSchema", False).load(path)
        elements = [f.name for f in found.schema if not f.name.startswith("_")]
    fields = [T.StructField("_rdf:about", T.StringType()), T.StructField("_about", T.StringType())]
    schema = T.StructType(fields + [T.StructField(e, child) for e in elements])
    rows = spark.read.format("xml").schema(schema).option("rowTag", row_tag).load(path)
    about = F.coalesce(F.col("`_rdf:about`"), F.col("_about"))
    name = F.sha2(F.concat_ws("|", F.input_file_name(), F.monotonically_increasing_id().cast("string")), 256)
    keyed = rows.select(F.coalesce(about, F.concat(F.lit("_:x"), name)).alias("s"), *[F.col(f"`{e}`") for e in elements])
    def labelled(element: str):
        p = F.lit(_iri(element, prefixes)).alias("p")
        return F.transform(F.col(f"`{element}`"), lambda c: F.struct(p, c.alias("c")))

    children = [labelled(e) for e in elements]
    flat = keyed.select("s", F.explode(F.flatten(F.array_compact(F.array(*children)))).alias("x")).select("s", "x.p", "x.c")
    link = F.coalesce(F.col("c")["_resource"], F.col("c")["_rdf:resource"])
    return flat.select(
        "s",
        "p",
        F.coalesce(link, F.col("c")["_VALUE"], F.lit("")).alias("o_value"),
        F.when(link.isNotNull(), "uri").otherwise("literal").alias("o_type"),
        F.when(link.isNull(), F.coalesce(F.col("c")["_rdf:datatype"], F.lit(""))).otherwise("").alias("o_datatype"),
        F.when(link.isNull(), F.coalesce(F.col("c")["_xml:lang"], F.lit(""))).otherwise("").alias("o_lang"),
        F.lit(graph).alias("g"),
    ).select(*QUAD)


def _iri(element: str, prefixes: dict[str, str]) -> str:
    prefix, _, local = element.rpartition(":")
    return prefixes[prefix] + local
