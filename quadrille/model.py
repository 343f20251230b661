"""Data model: one row per statement, one column per part of the statement.

A graph set is a DataFrame of *quads*. Absent datatype and language are written as ``''`` (never NULL),
so every column can be a plain equi-join key. Blank nodes carry the prefix ``_:`` in ``s`` and ``o_value``.

A solution column (a variable) has one of three shapes, told apart by its Spark type:

* node:   STRING, an IRI or blank node;
* term:   STRUCT<type, value, datatype, lang>, any RDF term;
* native: a number, timestamp, ... after the caller asked for a typed value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Vocabulary IRIs.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
RDF_TYPE = RDF + "type"
RDFS_SUBCLASS = RDFS + "subClassOf"
RDFS_SUBPROPERTY = RDFS + "subPropertyOf"
RDFS_DOMAIN = RDFS + "domain"
RDFS_RANGE = RDFS + "range"
OWL_DISJOINT = OWL + "disjointWith"
OWL_FUNCTIONAL = OWL + "FunctionalProperty"
XSD_STRING = XSD + "string"
XSD_INTEGER = XSD + "integer"
XSD_DECIMAL = XSD + "decimal"
XSD_DOUBLE = XSD + "double"
XSD_BOOLEAN = XSD + "boolean"
XSD_DATE = XSD + "date"
XSD_DATETIME = XSD + "dateTime"

DEFAULT_GRAPH = "urn:quadrille:default-graph"

QUAD = ["s", "p", "o_value", "o_type", "o_datatype", "o_lang", "g"]
TRIPLE = QUAD[:-1]
OBJECT = ["o_value", "o_type", "o_datatype", "o_lang"]

QUAD_SCHEMA = T.StructType([T.StructField(c, T.StringType(), False) for c in QUAD])
TERM_SCHEMA = T.StructType([T.StructField(c, T.StringType(), False) for c in ("type", "value", "datatype", "lang")])

# XSD datatypes whose values compare as numbers.
NUMERIC_TYPES = [
    XSD + n
    for n in ("integer", "decimal", "double", "float", "int", "long", "short", "byte", "nonNegativeInteger", "positiveInteger")
]


@dataclass(frozen=True)
class Lit:
    """A literal constant; a plain string literal has no datatype and no language."""

    value: str
    datatype: str = ""
    lang: str = ""

    def __post_init__(self):
        if self.datatype == XSD_STRING:
            object.__setattr__(self, "datatype", "")


@dataclass(frozen=True)
class Val:
    """A variable in object position that is read as a native Spark value of type ``as_type``.

    Objects that are no such value make no solution (a type error removes the row).
    ``as_type`` is one of double, long, string, boolean, date, timestamp.
    """

    var: str
    as_type: str = "double"


def is_var(x) -> bool:
    return isinstance(x, str) and x.startswith("?")


def node_type(col: Column) -> Column:
    return F.when(col.startswith("_:"), F.lit("bnode")).otherwise(F.lit("uri"))


def term(type_: Column, value: Column, datatype: Column | None = None, lang: Column | None = None) -> Column:
    empty = F.lit("")
    return F.struct(
        type_.alias("type"),
        value.alias("value"),
        (empty if datatype is None else datatype).alias("datatype"),
        (empty if lang is None else lang).alias("lang"),
    )


def node_term(col: Column) -> Column:
    """A node column as a term struct."""
    return term(node_type(col), col)


def object_term() -> Column:
    """The object of a quads row as a term struct."""
    return term(F.col("o_type"), F.col("o_value"), F.col("o_datatype"), F.col("o_lang"))


def constant_object(o) -> dict[str, str]:
    """Object columns of a constant: ``Lit`` or an IRI / blank node given as text."""
    if isinstance(o, Lit):
        return dict(o_value=o.value, o_type="literal", o_datatype=o.datatype, o_lang=o.lang)
    return dict(o_value=o, o_type="bnode" if o.startswith("_:") else "uri", o_datatype="", o_lang="")


def quads(spark: SparkSession, rows, graph: str = DEFAULT_GRAPH) -> DataFrame:
    """Quads from a few literal rows ``(s, p, o)`` or ``(s, p, o, g)``; for INSERT DATA and fixtures."""
    data = []
    for row in rows:
        s, p, o, *g = row
        c = constant_object(o)
        data.append((s, p, c["o_value"], c["o_type"], c["o_datatype"], c["o_lang"], g[0] if g else graph))
    return spark.createDataFrame(data, QUAD_SCHEMA)


def as_set(df: DataFrame) -> DataFrame:
    """Set semantics. ``distinct`` aggregates on the map side first, so a hot duplicate costs one row per task.

    Solutions without variables stay as they are: a distinct over no columns would turn none into one.
    """
    return df.distinct() if df.columns else df
