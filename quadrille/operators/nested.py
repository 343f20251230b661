"""Nested objects: entities of a class with fields as values, and lists, to any depth.

Nested results are shredded: every field is a level of its own, a flat table with a row per element, its place in the list it belongs to and the
row of the level above it belongs to. So two lists of one entity are as many rows as they have elements together, and no list is ever one value.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.iri import local_name
from ..model import RDF_TYPE
from ..session import cut
from .graph import EVERYTHING, Dataset, Graph, Pattern
from .patterns import bgp


@dataclass(frozen=True)
class Field:
    """A field: its name in the result and the predicate it reads; ``inverse`` reads it from object to subject.

    ``children`` are fields of the nodes it leads to, ``cls`` limits these to instances of a class.
    """

    name: str
    predicate: str
    children: tuple[Field, ...] = ()
    inverse: bool = False
    cls: str | None = None


def shown(col: Column, data_type: T.DataType) -> Column:
    """How a field value is shown: an IRI by its local name, a literal by its text."""
    if isinstance(data_type, T.StructType):
        return F.when(col["type"] == "uri", local_name(col["value"])).otherwise(col["value"])
    return local_name(col) if isinstance(data_type, T.StringType) else col


def select_fields(graph: Graph, cls: str | None, fields: list[Field], where: dict[str, object] | None = None,
                  dataset: Dataset = EVERYTHING) -> DataFrame:
    """One row per entity of a class and combination of field values: ``id`` and a column per field.

    ``where`` gives equality arguments: predicate -> term; they become constants of the match.
    """
    patterns = [] if cls is None else [Pattern("?id", RDF_TYPE, cls)]
    patterns += [Pattern("?id", p, o) for p, o in (where or {}).items()]
    patterns += [Pattern("?id", f.predicate, f"?{f.name}") for f in fields]
    found = bgp(graph, patterns, dataset)
    kinds = {f.name: f.dataType for f in found.schema}
    return found.select("id", *[shown(F.col(f.name), kinds[f.name]).alias(f.name) for f in fields])


@dataclass(frozen=True)
class Nested:
    """Levels by path: ``""`` for the entities, ``a/b`` for field ``b`` of field ``a``.

    A level has ``row``, its number in the level, ``parent``, the row of the level above (null for entities), ``position``, the place in the list
    from 0, ``id``, the node (null for a literal), and ``value``, how it is shown.
    """

    levels: dict[str, DataFrame]

    def flat(self) -> DataFrame:
        """All levels below the entities in one table: ``path, of, position, value``, where ``of`` is the value the element belongs to."""
        parts = []
        for path, level in self.levels.items():
            if path:
                above = self.levels[path.rpartition("/")[0]].select(F.col("row").alias("parent"), F.col("value").alias("of"))
                parts.append(level.join(above, "parent").select(F.lit(path).alias("path"), "of", "position", "value"))
        return reduce(DataFrame.unionByName, parts)

    def along(self, path: str) -> DataFrame:
        """The elements of one level with the ``id`` or value of every level above: one equality join of row numbers per level."""
        names = path.split("/")
        found = self.levels[path].select("parent", "position", F.col("value").alias(names[-1]))
        for depth in range(len(names) - 1, -1, -1):
            above, name = "/".join(names[:depth]), names[depth - 1] if depth else "entity"
            found = found.join(self.levels[above].select(F.col("row").alias("parent"), F.col("parent").alias("_up"), F.col("value").alias(name)), "parent")
            found = found.drop("parent").withColumnRenamed("_up", "parent")
        return found.drop("parent")


def select_nested(graph: Graph, cls: str | None, fields: list[Field], where: dict[str, object] | None = None, dataset: Dataset = EVERYTHING) -> Nested:
    """Entities of a class, with fields to any depth.

    ``where`` gives equality arguments: predicate -> term. Entities without a value for a field stay, and simply have no element there.
    Lists are in the order of their values. A node that is an element of several lists is a row in each.
    """
    patterns = [] if cls is None else [Pattern("?id", RDF_TYPE, cls)]
    patterns += [Pattern("?id", p, o) for p, o in (where or {}).items()]
    if not patterns:
        raise ValueError("entities need a class or an argument")
    entities = bgp(graph, patterns, dataset).select("id").distinct()
    top = entities.select(F.lit(None).cast("long").alias("parent"), "id", local_name(F.col("id")).alias("value"))
    levels = {"": _numbered(top)}
    left = [("", f) for f in fields]
    while left:
        above, field = left.pop(0)
        path = f"{above}/{field.name}" if above else field.name
        levels[path] = _numbered(_elements(graph, field, levels[above], dataset))
        left += [(path, child) for child in field.children]
    return Nested(levels)


def _numbered(rows: DataFrame) -> DataFrame:
    placed = nest(rows, ["parent"], ["value", "id"])
    return cut(placed.withColumn("row", F.monotonically_increasing_id()), "nested")


def _elements(graph: Graph, field: Field, above: DataFrame, dataset: Dataset) -> DataFrame:
    parents = above.filter("id IS NOT NULL").select(F.col("row").alias("parent"), F.col("id").alias("_of"))
    if field.inverse or field.children or field.cls:  # elements are nodes
        found = graph.match(Pattern("?v", field.predicate, "?_of") if field.inverse else Pattern("?_of", field.predicate, "?v"), frozenset(["?v", "?_of"]), dataset)
        if field.cls is not None:
            found = found.join(graph.match(Pattern("?v", RDF_TYPE, field.cls), frozenset(), dataset).select("v").distinct(), "v", "left_semi")
        return parents.join(found, "_of").select("parent", F.col("v").alias("id"), local_name(F.col("v")).alias("value"))
    found = graph.match(Pattern("?_of", field.predicate, "?v"), frozenset(), dataset)
    node = F.when(F.col("v")["type"] != "literal", F.col("v")["value"])
    return parents.join(found, "_of").select("parent", node.alias("id"), shown(F.col("v"), found.schema["v"].dataType).alias("value"))


def nest(rows: DataFrame, keys: list[str], columns: list[str], position: str = "position") -> DataFrame:
    """The elements of the list of each group, one row each: ``keys``, ``columns`` and the place in the list, from 0.

    Lists are in the order of ``columns``. A list may be of any length, so it is never brought into one value: rows are
    sorted over ranges of keys and columns, which is written, and places are counted within a range and added up over the ranges of
    a group.
    """
    ordered = rows.select(*keys, *columns).orderBy(*keys, *columns)
    placed = cut(ordered.withColumn("_id", F.monotonically_increasing_id()), "nested").withColumn("_range", F.shiftright("_id", 33))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_range").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    )
    starts = cut(starts, "starts")
    on = [placed["_range"] == starts["_range"], *[placed[k].eqNullSafe(starts[k]) for k in keys]]
    joined = placed.join(starts, reduce(Column.__and__, on))
    return joined.select(*[placed[c] for c in [*keys, *columns]], (starts["_before"] + placed["_id"] - starts["_first"]).alias(position))


def group_concat(rows: DataFrame, keys: list[str], column: str, separator: str, name: str, distinct: bool = False) -> DataFrame:
    """GROUP_CONCAT in ascending order, one text per group; ``distinct`` merges equal values before anything is brought together."""
    rows = rows.select(*keys, column).filter(F.col(column).isNotNull())
    if distinct:
        rows = rows.distinct()
    return rows.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(F.col(column).cast("string"))), separator).alias(name))
