"""Result files in SPARQL-JSON: ``{"head": {"vars": [...]}, "results": {"bindings": [...]}}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.terms import decode_term
from ..model import XSD_STRING

_TERM = T.StructType([T.StructField(n, T.StringType()) for n in ("type", "value", "datatype", "xml:lang", "lang")])


def _binding(variables: list[str]) -> T.StructType:
    return T.StructType([T.StructField(v, _TERM) for v in variables])


def _as_terms(df: DataFrame, variables: list[str], source: str) -> DataFrame:
    def one(v):
        t = F.col(source)[v]
        # A tag no term has fails the job; the check sits in the type itself, so it cannot be optimised away.
        type_ = F.when(t["type"] == "typed-literal", "literal").when(decode_term(t["type"], t["value"]).isNotNull(), t["type"])
        value = F.when((t["type"] == "bnode") & ~t["value"].startswith("_:"), F.concat(F.lit("_:"), t["value"])).otherwise(t["value"])
        datatype = F.coalesce(t["datatype"], F.lit(""))
        term = F.struct(
            type_.alias("type"),
            value.alias("value"),
            F.when(datatype == XSD_STRING, "").otherwise(datatype).alias("datatype"),
            F.coalesce(t["xml:lang"], t["lang"], F.lit("")).alias("lang"),
        )
        return F.when(t.isNotNull(), term).alias(v)

    return df.select(*[one(v) for v in variables])


def read_results_json(spark: SparkSession, path: str | list[str], variables: list[str], documents: bool = True) -> DataFrame:
    """One row per solution, one term column per variable; unbound variables are NULL.

    A document without ``head.vars`` or ``results.bindings`` fails the job. ``documents``: each file is one document;
    otherwise each line is one.
    """
    head = T.StructType([T.StructField("vars", T.ArrayType(T.StringType()))])
    results = T.StructType([T.StructField("bindings", T.ArrayType(_binding(variables)))])
    schema = T.StructType([T.StructField("head", head), T.StructField("results", results)])
    docs = spark.read.schema(schema).option("multiLine", documents).option("mode", "FAILFAST").json(path)
    complete = F.col("head.vars").isNotNull() & F.col("results.bindings").isNotNull()
    bindings = F.when(complete, F.col("results.bindings")).otherwise(
        F.raise_error(F.lit("not a result document: head.vars and results.bindings are required"))
    )
    return _as_terms(docs.select(F.explode(bindings).alias("b")), variables, "b")


def read_bindings_json(spark: SparkSession, path: str | list[str], variables: list[str]) -> DataFrame:
    """Solutions written one binding object per line; large files are split over many tasks."""
    lines = spark.read.schema(_binding(variables)).option("mode", "FAILFAST").json(path)
    return _as_terms(lines.select(F.struct(*variables).alias("b")), variables, "b")
