"""Strict scalar conversions and the columns of answer logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings, case-sensitive as listed.
TRUE_TEXTS = ["y", "yes", "t", "true", "True", "on"]
FALSE_TEXTS = ["n", "no", "f", "false", "False", "off"]

# Tags of the actions in an answer log.
ACTION_QUESTION = "rewritten_query"
ACTION_QUERY = "sparql"

ACTIONS_SCHEMA = T.ArrayType(
    T.StructType([T.StructField(c, T.StringType()) for c in ("type", "label", "value")])
)


def parse_bool_strict(col: Column) -> Column:
    """Boolean of a text by the fixed spellings; any other text fails the job."""
    return (
        F.when(col.isin(TRUE_TEXTS), True)
        .when(col.isin(FALSE_TEXTS), False)
        .otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(col, F.lit("null")))).cast("boolean"))
    )


def first_action(actions: Column, kind: str) -> Column:
    """``value`` of the first action of one kind, NULL when there is none."""
    if_json = F.from_json(actions, ACTIONS_SCHEMA)
    hits = F.filter(if_json, lambda a: a["type"] == kind)
    return F.get(hits, F.lit(0))["value"]


def is_uuid(col: Column) -> Column:
    """True for a UUID: 32 hex digits after dropping ``urn:uuid:``, braces and hyphens anywhere, in any case."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(col, "urn:|uuid:", ""), r"^[{}]+|[{}]+$", ""), "-", "")
    return F.coalesce(bare.rlike("^[0-9A-Fa-f]{32}$"), F.lit(False))
