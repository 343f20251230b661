"""Solutions as CSV, TSV and JSON. Every task writes its own file; nothing is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.terms import term_text
from ..operators.mapping import node_or_term


def as_terms(df: DataFrame, text: tuple[str, ...] = ()) -> DataFrame:
    """All columns as term structs. Text columns are nodes, unless named in ``text``: those are plain literals."""
    out = []
    for f in df.schema:
        col = F.col(f"`{f.name}`")
        if f.name in text:
            empty = F.lit("")
            made = F.struct(F.lit("literal").alias("type"), col.alias("value"), empty.alias("datatype"), empty.alias("lang"))
        else:
            made = node_or_term(col, f.dataType, bool(f.metadata.get("literal")))
        out.append(F.when(col.isNotNull(), made).alias(f.name))
    return df.select(*out)


def csv_rows(df: DataFrame) -> DataFrame:
    """Bare values under bare variable names; unbound is empty."""
    def bare(f):
        col = F.col(f"`{f.name}`")
        return (col["value"] if isinstance(f.dataType, T.StructType) else col.cast("string")).alias(f.name)

    return df.select(*[bare(f) for f in df.schema])


def write_csv(df: DataFrame, path: str) -> None:
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    csv_rows(df).write.options(**kept).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def tsv_rows(df: DataFrame, text: tuple[str, ...] = ()) -> DataFrame:
    """Terms in N-Triples syntax under ``?name`` headers. Line breaks and tabs are escaped by the syntax itself."""
    terms = as_terms(df, text)

    def one(c):
        t = F.col(f"`{c}`")
        return term_text(t["type"], t["value"], t["datatype"], t["lang"]).alias(f"?{c}")

    return terms.select(*[one(c) for c in terms.columns])


def write_tsv(df: DataFrame, path: str, text: tuple[str, ...] = ()) -> None:
    """The syntax needs no further quoting, so lines are written as text with the header as the first line of a file."""
    rows = tsv_rows(df, text)
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(**kept).option("header", True).option("sep", "\t").option("quote", "\u0000").option("escape", "\u0000").option(
        "escapeQuotes", False
    ).csv(path)


def json_bindings(df: DataFrame, text: tuple[str, ...] = ()) -> DataFrame:
    """One binding object per row in column ``value``: ``{"x": {"type":.., "value":.., ...}, ...}``.

    Absent datatype and language are left out, and so are unbound variables.
    """
    terms = as_terms(df, text)

    def one(c):
        t = F.col(f"`{c}`")
        fields = F.struct(
            t["type"].alias("type"),
            F.when(t["type"] == "bnode", F.regexp_replace(t["value"], "^_:", "")).otherwise(t["value"]).alias("value"),
            F.when(t["datatype"] != "", t["datatype"]).alias("datatype"),
            F.when(t["lang"] != "", t["lang"]).alias("xml:lang"),
        )
        return F.when(t.isNotNull(), fields).alias(c)

    return terms.select(F.to_json(F.struct(*[one(c) for c in terms.columns])).alias("value"))


def write_json(df: DataFrame, path: str, text: tuple[str, ...] = ()) -> None:
    """Binding objects, one per line below ``bindings``, and the variable names below ``head``."""
    json_bindings(df, text).write.text(f"{path}/bindings")
    head = df.sparkSession.createDataFrame([(df.columns,)], "vars array<string>")
    head.coalesce(1).write.json(f"{path}/head")
