"""Graph patterns as DataFrames: what to match, and the graphs a match runs on.

A :class:`Graph` answers one question: the solutions of one triple pattern. Three kinds exist: stored quads, mapped
tables (see mapping.py) and unions of both. Joins of patterns are built on top of it in patterns.py.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.iri import encode_iri_part
from ..functions.terms import value_of
from ..model import (
    DEFAULT_GRAPH,
    QUAD,
    Val,
    as_set,
    constant_object,
    is_var,
    object_term,
)
from ..session import join_lookup


@dataclass(frozen=True)
class Pattern:
    """``s p o`` with ``?name`` variables, in the default graph or, with ``graph``, in a named one.

    ``s`` and ``p`` are IRIs or variables. ``o`` is an IRI, a ``Lit``, a variable, or ``Val('?x', type)`` for a
    variable read as a native value.
    """

    s: str
    p: str
    o: object
    graph: str | None = None

    @property
    def object_var(self) -> str | None:
        if isinstance(self.o, Val):
            return self.o.var
        return self.o if is_var(self.o) else None

    @property
    def node_variables(self) -> list[str]:
        """Variables in positions that only hold IRIs and blank nodes."""
        return [v for v in (self.s, self.p, self.graph) if is_var(v)]

    @property
    def variables(self) -> list[str]:
        out = []
        for v in (self.s, self.p, self.object_var, self.graph):
            if is_var(v) and v not in out:
                out.append(v)
        return out

    @property
    def constants(self) -> int:
        return sum((not is_var(self.s), not is_var(self.p), self.object_var is None))


@dataclass(frozen=True)
class Dataset:
    """Which graphs a match sees.

    ``default``: these graphs, merged as a set, are the default graph (FROM, USING). ``named``: the graphs that
    ``GRAPH`` ranges over (FROM NAMED). With neither, the default graph is the unnamed one and GRAPH sees every
    named graph. As soon as one of the two is given, the other is empty when left out.
    """

    default: tuple[str, ...] | None = None
    named: tuple[str, ...] | None = None

    @classmethod
    def of(cls, default=None, named=None) -> Dataset:
        return cls(None if default is None else tuple(default), None if named is None else tuple(named))

    @property
    def given(self) -> bool:
        return self.default is not None or self.named is not None

    def default_graphs(self) -> tuple[str, ...]:
        if self.default is not None:
            return self.default
        return () if self.given else (DEFAULT_GRAPH,)

    def named_filter(self, g: Column) -> Column:
        if self.named is not None:
            return g.isin(list(self.named)) if self.named else F.lit(False)
        return F.lit(False) if self.given else g != DEFAULT_GRAPH

    def may_use(self, graph: str, pattern: Pattern) -> bool:
        """Whether a pattern can see a graph, decided without touching data."""
        if pattern.graph is None:
            return graph in self.default_graphs()
        if not is_var(pattern.graph) and pattern.graph != graph:
            return False
        if self.named is not None:
            return graph in self.named
        return not self.given and graph != DEFAULT_GRAPH


EVERYTHING = Dataset()


@dataclass(frozen=True)
class Key:
    """A node column kept as the bare key of its IRI: a number or text between a fixed head and tail.

    Two sides with equal ``Key`` join on the bare value, which is shorter than the IRI and a plain column of the source.
    """

    head: str
    tail: str
    number: bool

    def iri(self, col: Column) -> Column:
        text = col.cast("string") if self.number else encode_iri_part(col)
        return F.concat(F.lit(self.head), text, F.lit(self.tail)) if self.tail else F.concat(F.lit(self.head), text)


def with_iris(df: DataFrame, keys: dict[str, Key], names=None) -> DataFrame:
    """Bare keys as IRIs, all of them or those of some columns."""
    chosen = [c for c in keys if names is None or c in names]
    if not chosen:
        return df
    return df.select(*[keys[c].iri(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])


class Graph(ABC):
    """A set of quads that can be matched."""

    @abstractmethod
    def match(self, pattern: Pattern, nodes: frozenset[str] = frozenset(), dataset: Dataset = EVERYTHING) -> DataFrame:
        """Solutions of one pattern: one column per variable, named without the question mark.

        Variables in ``nodes`` are wanted as node columns wherever they stand, so that they join by plain equality.
        """

    def match_keys(self, pattern: Pattern, nodes: frozenset[str], dataset: Dataset) -> tuple[DataFrame, dict[str, Key]]:
        """As ``match``, but node columns may still be bare keys; the second part says which."""
        return self.match(pattern, nodes, dataset), {}

    def match_star(self, patterns, nodes: frozenset[str], dataset: Dataset) -> tuple[DataFrame, dict[str, Key]] | None:
        """Solutions of several patterns with one subject from a single scan, when the graph knows how."""
        return None

    def statements(self, predicates: list[str], dataset: Dataset = EVERYTHING) -> DataFrame:
        """``s, p, o`` of the statements with any of some predicates, the object as a term."""
        parts = [self.match(Pattern("?s", p, "?o"), frozenset(), dataset).select("s", F.lit(p).alias("p"), "o") for p in predicates]
        return reduce(DataFrame.unionByName, parts)

    def match_any(self, pattern: Pattern, names: DataFrame, dataset: Dataset = EVERYTHING) -> DataFrame:
        """Solutions of a pattern with any of the predicates ``names(p)`` in the place of its own, as a set and with the object as a term.

        One scan of the graph, however many predicates there are.
        """
        wide = Pattern(pattern.s, "?_p", pattern.object_var or pattern.o, pattern.graph)
        found = self.match(wide, frozenset(), dataset)
        return as_set(join_lookup(found, names.select(F.col("p").alias("_p")), ["_p"], "left_semi").drop("_p"))

    @abstractmethod
    def quads(self) -> DataFrame:
        """All quads."""

    def dataset_quads(self, dataset: Dataset) -> DataFrame:
        """``s p o`` rows of the dataset's default graph, as a set."""
        graphs = list(dataset.default_graphs())
        found = self.quads().filter(F.col("g").isin(graphs) if graphs else F.lit(False)).drop("g")
        return as_set(found) if len(graphs) > 1 else found


def object_column(pattern: Pattern, nodes: frozenset[str]) -> tuple[Column, Column | None]:
    """The object variable of quads rows as node, native or term column, and the filter that goes with it."""
    if isinstance(pattern.o, Val):
        value = value_of(F.col("o_type"), F.col("o_value"), F.col("o_datatype"), pattern.o.as_type)
        return value, value.isNotNull()
    if pattern.o in nodes:
        return F.col("o_value"), F.col("o_type").isin("uri", "bnode")
    return object_term(), None


def solutions(found: DataFrame, pattern: Pattern, nodes: frozenset[str]) -> DataFrame:
    """Quads that satisfy a pattern's constants -> one column per variable; repeated variables become filters."""
    nodes = nodes | frozenset(pattern.node_variables)
    columns: dict[str, Column] = {}
    for var, name in ((pattern.s, "s"), (pattern.p, "p"), (pattern.graph, "g")):
        if is_var(var):
            if var in columns:
                found = found.filter(columns[var] == F.col(name))
            columns.setdefault(var, F.col(name))
    var = pattern.object_var
    if var is not None:
        if isinstance(pattern.o, Val) and var in columns:
            raise ValueError(f"{var} is a node elsewhere in the pattern and cannot be read as a value")
        column, condition = object_column(pattern, nodes)
        if condition is not None:
            found = found.filter(condition)
        if var in columns:
            found = found.filter(columns[var] == column)
        columns.setdefault(var, column)
    return found.select(*[c.alias(v[1:]) for v, c in columns.items()])


def constant_filters(pattern: Pattern) -> list[Column]:
    """Filters for a pattern's constants; each is a plain comparison of one column and reaches the scan."""
    out = []
    if not is_var(pattern.s):
        out.append(F.col("s") == pattern.s)
    if not is_var(pattern.p):
        out.append(F.col("p") == pattern.p)
    if pattern.object_var is None:
        out += [F.col(k) == v for k, v in constant_object(pattern.o).items()]
    return out


class StoredGraph(Graph):
    """Quads in a table or file. Partitioned by ``p``, a constant predicate reads only its own folder."""

    def __init__(self, df: DataFrame):
        self._quads = df.select(*QUAD)

    def quads(self) -> DataFrame:
        return self._quads

    def statements(self, predicates, dataset=EVERYTHING):
        graphs = list(dataset.default_graphs())
        found = self._quads.filter(F.col("p").isin(list(predicates))).filter(F.col("g").isin(graphs) if graphs else F.lit(False))
        return (as_set(found.drop("g")) if len(graphs) > 1 else found).select("s", "p", object_term().alias("o"))

    def match(self, pattern, nodes=frozenset(), dataset=EVERYTHING):
        found = reduce(DataFrame.filter, constant_filters(pattern), self._quads)
        if pattern.graph is None:
            graphs = list(dataset.default_graphs())
            found = found.filter(F.col("g").isin(graphs) if graphs else F.lit(False))
            if len(graphs) > 1:
                found = as_set(found.drop("g"))
        else:
            found = found.filter(dataset.named_filter(F.col("g")))
            if not is_var(pattern.graph):
                found = found.filter(F.col("g") == pattern.graph)
        return solutions(found, pattern, nodes)


class UnionGraph(Graph):
    """Several graphs seen as one, e.g. stored quads and mapped tables.

    ``disjoint`` says that no quad is in two members, which saves the shuffle that merges them as a set.
    """

    def __init__(self, *members: Graph, disjoint: bool = False):
        self.members, self.disjoint = members, disjoint

    def quads(self):
        every = reduce(DataFrame.unionByName, [m.quads() for m in self.members])
        return every if self.disjoint else as_set(every)

    def statements(self, predicates, dataset=EVERYTHING):
        every = reduce(DataFrame.unionByName, [m.statements(predicates, dataset) for m in self.members])
        return every if self.disjoint and len(dataset.default_graphs()) <= 1 else as_set(every)

    def match_any(self, pattern, names, dataset=EVERYTHING):
        return as_set(reduce(DataFrame.unionByName, [m.match_any(pattern, names, dataset) for m in self.members]))

    def match(self, pattern, nodes=frozenset(), dataset=EVERYTHING):
        if self.disjoint and (pattern.graph is not None or len(dataset.default_graphs()) <= 1):
            return reduce(DataFrame.unionByName, [m.match(pattern, nodes, dataset) for m in self.members])
        # Merge as triples first: two spellings of one number are two triples, and two solutions.
        merged = merge_as_terms([m for m in self.members], pattern, dataset)
        return from_terms(merged, pattern, nodes)


def merge_as_terms(members, pattern: Pattern, dataset: Dataset) -> DataFrame:
    """Union of the members' solutions with the object as a term, without duplicates."""
    plain = Pattern(pattern.s, pattern.p, pattern.object_var or pattern.o, pattern.graph)
    found = [m.match(plain, frozenset(), dataset) for m in members]
    return as_set(reduce(DataFrame.unionByName, found))


def from_terms(found: DataFrame, pattern: Pattern, nodes: frozenset[str]) -> DataFrame:
    """Turn the object term of merged solutions into the node or native column that was asked for."""
    var = pattern.object_var
    if var is None or var in pattern.node_variables:
        return found
    name = var[1:]
    if isinstance(pattern.o, Val):
        col = F.col(name)
        value = value_of(col["type"], col["value"], col["datatype"], pattern.o.as_type)
        return found.withColumn(name, value).filter(F.col(name).isNotNull())
    if var in nodes:
        return found.filter(F.col(name)["type"].isin("uri", "bnode")).withColumn(name, F.col(name)["value"])
    return found

