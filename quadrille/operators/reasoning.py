"""Inference over class and property hierarchies.

A hierarchy is closed level by level: each level joins only the pairs found last with the direct edges. Every level is
materialised in the shared checkpoint folder, so plans stay short and a lost executor costs one level at most.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import (
    OBJECT,
    OWL_DISJOINT,
    OWL_FUNCTIONAL,
    QUAD,
    RDF_TYPE,
    RDFS_DOMAIN,
    RDFS_RANGE,
    RDFS_SUBCLASS,
    RDFS_SUBPROPERTY,
    as_set,
    is_var,
)
from ..session import BROADCAST_BYTES, TASK_ROWS, cut, cut_measured, join_lookup
from .graph import EVERYTHING, Dataset, Graph, Pattern, StoredGraph, UnionGraph, from_terms
from .hierarchy import Hierarchy

NODES = ("uri", "bnode")


def schema_edges(graph: Graph, predicate: str, schema_graphs: list[str] | None = None) -> DataFrame:
    """Direct ``(sub, super)`` edges; ``schema_graphs`` limits where the schema is read from."""
    dataset = EVERYTHING if schema_graphs is None else Dataset.of(default=schema_graphs)
    found = graph.match(Pattern("?sub", predicate, "?super"), frozenset(["?super"]), dataset)
    return found.filter(F.col("sub") != F.col("super"))


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All pairs ``(sub, super)`` joined by one or more edges, with ``chain``: the nodes of a shortest way.

    Of several shortest ways the smallest by text is kept, so the result does not depend on the order of rows.
    Ends on cycles too: a pair is extended only at the level it is first found.
    """
    edges, measured = cut_measured(edges.select("sub", "super").distinct())
    step = edges.select(F.col("sub").alias("super"), F.col("super").alias("_next"))
    small = measured["bytes"] <= BROADCAST_BYTES
    levels, seen = [edges.withColumn("chain", F.array("sub", "super"))], edges
    while measured["bytes"]:
        last = levels[-1]
        reached = (
            last.join(F.broadcast(step) if small else step, "super")
            .select("sub", F.col("_next").alias("super"), F.array_append("chain", F.col("_next")).alias("chain"))
            .groupBy("sub", "super").agg(F.min("chain").alias("chain"))
            .join(seen, ["sub", "super"], "left_anti")
        )
        reached, measured = cut_measured(reached)
        levels.append(reached)
        seen = seen.unionByName(reached.select("sub", "super"))
    return reduce(DataFrame.unionByName, levels)


def subclass_closure(graph: Graph, schema_graphs: list[str] | None = None) -> DataFrame:
    return transitive_closure(schema_edges(graph, RDFS_SUBCLASS, schema_graphs))


def subproperty_closure(graph: Graph, schema_graphs: list[str] | None = None) -> DataFrame:
    return transitive_closure(schema_edges(graph, RDFS_SUBPROPERTY, schema_graphs))


def infer_types(types: DataFrame, closure: DataFrame) -> DataFrame:
    """``(s, cls)`` with every superclass added, as a set. One class may hold most rows: see ``join_lookup``.

    A row becomes one for each superclass within its task, so types are dealt by what they become, which is counted before.
    """
    types = types.select("s", "cls")
    up, seen = cut_measured(closure.select(F.col("sub").alias("cls"), F.col("super").alias("_super")), "lookup")
    small = seen["bytes"] <= BROADCAST_BYTES
    derived = join_lookup(types, up, ["cls"], small=small)
    tasks = 1 + derived.count() // TASK_ROWS
    if small and tasks > 1:
        types = types.repartition(tasks, "s", "cls")
        derived = join_lookup(types, up, ["cls"], small=small)
    return as_set(types.unionByName(derived.select("s", F.col("_super").alias("cls"))))


def instances(graph: Graph, dataset: Dataset = EVERYTHING) -> DataFrame:
    """Asserted ``(s, cls)``."""
    found = graph.match(Pattern("?s", RDF_TYPE, "?cls"), frozenset(["?cls"]), dataset)
    return found.select("s", "cls")


class ReasonedGraph(Graph):
    """A graph seen with its entailments by subclasses, subproperties, domains and ranges; matches take it like any other graph.

    A constant predicate or class takes its names from intervals of the hierarchy (see :class:`Hierarchy`), as a table that is joined with one scan.
    Closures are only made where everything is asked for.
    """

    def __init__(self, base: Graph, schema_graphs: list[str] | None = None, properties: bool = True):
        self.base, self.schema_graphs, self._with_properties = base, schema_graphs, properties
        rules = domain_range_schema(base)
        if properties:
            # A property has the domains and ranges of what it is a subproperty of.
            rules = cut(rules, "rules")
            below = self._property_tree.below(rules.select(F.col("p").alias("name"))).select(F.col("name").alias("p"), "below")
            rules = below.join(rules, "p").select(F.col("below").alias("p"), "rule", "cls")
        self.rules, seen = cut_measured(rules.distinct(), "rules")
        self._typed = base if not seen["bytes"] else UnionGraph(base, StoredGraph(domain_range_quads(base.quads(), self.rules)))

    @cached_property
    def _class_tree(self) -> Hierarchy:
        return Hierarchy(schema_edges(self.base, RDFS_SUBCLASS, self.schema_graphs))

    @cached_property
    def _property_tree(self) -> Hierarchy:
        return Hierarchy(schema_edges(self.base, RDFS_SUBPROPERTY, self.schema_graphs))

    @cached_property
    def classes(self) -> DataFrame:
        return subclass_closure(self.base, self.schema_graphs)

    @cached_property
    def properties(self) -> DataFrame | None:
        return subproperty_closure(self.base, self.schema_graphs) if self._with_properties else None

    def _below(self, tree: Hierarchy, name: str) -> DataFrame:
        """Names below one name, and itself, written."""
        one = self.rules.sparkSession.createDataFrame([(name,)], "name string")
        return cut(tree.below(one).select("below"), "below")

    def match(self, pattern, nodes=frozenset(), dataset=EVERYTHING):
        if is_var(pattern.p):
            return StoredGraph(self.quads()).match(pattern, nodes, dataset)
        if pattern.p == RDF_TYPE:
            return self._match_type(pattern, nodes, dataset)
        if not self._with_properties:
            return self.base.match(pattern, nodes, dataset)
        names = self._below(self._property_tree, pattern.p)
        if len(names.limit(2).take(2)) == 1:  # nothing below it
            return self.base.match(pattern, nodes, dataset)
        return from_terms(self.base.match_any(pattern, names.withColumnRenamed("below", "p"), dataset), pattern, nodes)

    def _match_type(self, pattern, nodes, dataset):
        if pattern.object_var is not None:
            wide = Pattern(pattern.s, RDF_TYPE, pattern.object_var, pattern.graph)
            name = pattern.object_var[1:]
            direct = self._typed.match(wide, nodes | {pattern.object_var}, dataset)
            up = self.classes.select(F.col("sub").alias(name), F.col("super").alias("_super"))
            more = join_lookup(direct, up, [name]).withColumn(name, F.col("_super")).select(*direct.columns)
            return as_set(direct.unionByName(more))
        wide = Pattern(pattern.s, RDF_TYPE, "?_cls", pattern.graph)
        if not isinstance(pattern.o, str):  # a literal is no class
            return self._typed.match(pattern, nodes, dataset)
        names = self._below(self._class_tree, pattern.o).withColumnRenamed("below", "_cls")
        found = join_lookup(self._typed.match(wide, nodes | {"?_cls"}, dataset), names, ["_cls"], "left_semi").drop("_cls")
        return as_set(found) if pattern.variables else found.limit(1)

    def quads(self):
        base = self.base.quads()
        typed = base if self._typed is self.base else base.unionByName(domain_range_quads(base, self.rules))
        out = [typed, inferred_types(typed, self.classes)]
        if self.properties is not None:
            out.append(inferred_properties(base, self.properties))
        return as_set(reduce(DataFrame.unionByName, out))


def inferred_types(quads: DataFrame, closure: DataFrame) -> DataFrame:
    """Type quads that follow from the class hierarchy, in the graph of the quad they follow from."""
    up = closure.select(F.col("sub").alias("o_value"), F.col("super").alias("_super"))
    typed = quads.filter((F.col("p") == RDF_TYPE) & F.col("o_type").isin(*NODES))
    return join_lookup(typed, up, ["o_value"]).withColumn("o_value", F.col("_super")).select(*QUAD).distinct()


def inferred_properties(quads: DataFrame, closure: DataFrame) -> DataFrame:
    """Quads that follow from the property hierarchy."""
    up = closure.select(F.col("sub").alias("p"), F.col("super").alias("_super"))
    return join_lookup(quads, up, ["p"]).withColumn("p", F.col("_super")).select(*QUAD).distinct()


def domain_range_types(quads: DataFrame, schema: DataFrame) -> DataFrame:
    """``(s, cls)`` that follow from rdfs:domain and rdfs:range; only nodes get a range type.

    ``schema`` has columns ``p, rule, cls`` with rule ``domain`` or ``range``; see :func:`domain_range_schema`.
    """
    met = join_lookup(quads.select("s", "p", "o_value", "o_type"), schema, ["p"])
    both = met.select(
        F.when(F.col("rule") == "domain", F.col("s")).when(F.col("o_type").isin(*NODES), F.col("o_value")).alias("s"), "cls"
    )
    return both.filter(F.col("s").isNotNull()).distinct()


def domain_range_quads(quads: DataFrame, schema: DataFrame) -> DataFrame:
    """As :func:`domain_range_types`, as type quads in the graph of the quad they follow from."""
    met = join_lookup(quads.select("s", "p", "o_value", "o_type", "g"), schema, ["p"])
    node = F.when(F.col("rule") == "domain", F.col("s")).when(F.col("o_type").isin(*NODES), F.col("o_value"))
    made = met.select(
        node.alias("s"), F.lit(RDF_TYPE).alias("p"), F.col("cls").alias("o_value"), F.lit("uri").alias("o_type"), F.lit("").alias("o_datatype"),
        F.lit("").alias("o_lang"), "g",
    )
    return made.filter(F.col("s").isNotNull()).distinct()


def domain_range_schema(graph: Graph) -> DataFrame:
    def one(predicate, rule):
        found = graph.match(Pattern("?p", predicate, "?cls"), frozenset(["?cls"]))
        return found.select("p", F.lit(rule).alias("rule"), "cls")

    return one(RDFS_DOMAIN, "domain").unionByName(one(RDFS_RANGE, "range"))


def explain_inference(asked: DataFrame, quads: DataFrame, closure: DataFrame) -> DataFrame:
    """Why given type statements ``(s, cls)`` hold: ``status`` and ``proof``.

    ASSERTED: the statement is stored. INFERRED: a stored class of the subject reaches it; the proof is the chain of
    classes, the shortest and then smallest one. Statements that do not hold are left out.
    """
    typed = quads.filter((F.col("p") == RDF_TYPE) & F.col("o_type").isin(*NODES)).select("s", F.col("o_value").alias("cls"))
    mine = typed.join(asked.select("s").distinct(), "s", "left_semi").distinct()
    up = closure.select(F.col("sub").alias("cls"), F.col("super").alias("_to"), "chain")
    direct = mine.select("s", F.col("cls").alias("_to"), F.array("cls").alias("chain"))
    derived = join_lookup(mine, up, ["cls"]).select("s", "_to", "chain")
    proofs = direct.unionByName(derived).withColumnRenamed("_to", "cls")
    best = (
        asked.select("s", "cls").distinct().join(proofs, ["s", "cls"])
        .groupBy("s", "cls").agg(F.min(F.struct(F.size("chain").alias("n"), "chain")).alias("best"))
    )
    status = F.when(F.col("best.n") == 1, "ASSERTED").otherwise("INFERRED")
    return best.select("s", "cls", status.alias("status"), F.col("best.chain").alias("proof"))


_FACT = ["s", "p", "o_value", "o_type", "o_datatype", "o_lang"]


def explain_statements(asked: DataFrame, graph: Graph) -> DataFrame:
    """Why statements hold: the asked ones (columns of a triple) that do, with ``status`` and ``proof``.

    ASSERTED: the statement is stored, in whatever graph, and the proof is empty. INFERRED: the proof is the array of steps ``(rule, s, p, o, by_s,
    by_p, by_o)`` from a stored statement on. Every step concludes ``s p o`` from the step before (the first one from the stored statement ``from_s
    from_p from_o``) and one stored schema statement ``by``: rule ``subproperty``, ``subclass``, ``domain``, ``range``, or ``transitive`` for
    schema statements themselves. Proofs are of least length; of several the smallest premise by text is kept at each step.

    Only statements about asked subjects can take part, so the loop starts from these. Each level holds what is new, its rule and the premises
    found first; a pass back over the levels then unfolds the asked statements alone.
    """
    asked = cut(asked.select(*_FACT).distinct(), "asked")
    subjects = asked.select("s").distinct()
    stored = as_set(graph.quads().select(*_FACT))
    about = join_lookup(stored, subjects, ["s"], "left_semi")
    to = join_lookup(stored.filter(F.col("o_type").isin(*NODES)), subjects.withColumnRenamed("s", "o_value"), ["o_value"], "left_semi")
    schema = {p: schema_edges(graph, p).withColumnRenamed("super", "to") for p in (RDFS_SUBPROPERTY, RDFS_SUBCLASS)}
    schema |= {p: graph.match(Pattern("?sub", p, "?to"), frozenset(["?to"])).select("sub", "to") for p in (RDFS_DOMAIN, RDFS_RANGE)}
    # Measured once: every level joins with the same schema statements.
    measured = {p: cut_measured(df.distinct(), "schema") for p, df in schema.items()}
    level, seen = cut_measured(as_set(about.unionByName(to)), "facts")
    levels, known = [level], level

    def concluded(facts: DataFrame, rule: str, predicate: str, met: str, fact: dict[str, Column], only: Column | None = None) -> DataFrame:
        """Conclusions of one rule: ``met`` is the column of a fact that the schema statement starts from."""
        held = facts if only is None else facts.filter(only)
        by, size = measured[predicate]
        by = by.select(F.col("sub").alias(met), F.col("to").alias("_to"))
        premises = [F.col(c).alias(f"from_{c}") for c in _FACT]
        new = [fact.get(c, F.col(c)).alias(c) for c in _FACT]
        found = join_lookup(held, by, [met], small=size["bytes"] <= BROADCAST_BYTES)
        return found.select(*new, *premises, F.lit(rule).alias("rule"), F.col(met).alias("by_s"), F.lit(predicate).alias("by_p"), F.col("_to").alias("by_o"))

    a_class = {"p": F.lit(RDF_TYPE), "o_value": F.col("_to"), "o_type": F.lit("uri"), "o_datatype": F.lit(""), "o_lang": F.lit("")}
    node = F.col("o_type").isin(*NODES)
    while seen["bytes"]:
        last = levels[-1].select(*_FACT)
        made = [
            concluded(last, "subproperty", RDFS_SUBPROPERTY, "p", {"p": F.col("_to")}),
            concluded(last, "subclass", RDFS_SUBCLASS, "o_value", {"o_value": F.col("_to"), "o_type": F.lit("uri")}, (F.col("p") == RDF_TYPE) & node),
            concluded(last, "domain", RDFS_DOMAIN, "p", a_class),
            concluded(last, "range", RDFS_RANGE, "p", {**a_class, "s": F.col("o_value")}, node),
            *[concluded(last, "transitive", p, "o_value", {"o_value": F.col("_to"), "o_type": F.lit("uri")}, F.col("p") == p) for p in (RDFS_SUBPROPERTY, RDFS_SUBCLASS)],
        ]
        every = reduce(DataFrame.unionByName, made)
        best = F.min(F.struct("rule", *[f"from_{c}" for c in _FACT], "by_s", "by_p", "by_o")).alias("why")
        new = every.groupBy(*_FACT).agg(best).join(known, _FACT, "left_anti")
        level, seen = cut_measured(new.select(*_FACT, "why.*"), "facts")
        levels.append(level)
        known = known.unionByName(level.select(*_FACT))
    step = "array<struct<rule:string,s:string,p:string,o:string,by_s:string,by_p:string,by_o:string>>"
    goal = [F.col(c).alias(f"asked_{c}") for c in _FACT]
    open_ = None
    for i in range(len(levels) - 1, -1, -1):
        found = asked.join(levels[i].select(*_FACT), _FACT, "left_semi").select(*goal, *_FACT, F.array().cast(step).alias("proof"), F.lit(i).alias("height"))
        open_ = found if open_ is None else open_.unionByName(found)
        if i:
            why = levels[i]
            this = F.struct("rule", "s", "p", F.col("o_value").alias("o"), "by_s", "by_p", "by_o")
            open_ = open_.join(why, _FACT).select(
                *[f"asked_{c}" for c in _FACT], *[F.col(f"from_{c}").alias(c) for c in _FACT], F.concat(F.array(this), F.col("proof")).alias("proof"), "height")
    status = F.when(F.col("height") == 0, "ASSERTED").otherwise("INFERRED")
    start = [F.col(c).alias(f"from_{n}") for c, n in (("s", "s"), ("p", "p"), ("o_value", "o"))]
    return open_.select(*[F.col(f"asked_{c}").alias(c) for c in _FACT], status.alias("status"), *start, "proof")


def contradictions(data: DataFrame, schema: DataFrame, graph: str | None = None) -> DataFrame:
    """Rows ``(kind, s, p, first, second)`` where data contradict the schema; both are quads.

    disjoint: an instance of two classes declared owl:disjointWith, also by subclasses, domains and ranges of the schema.
    functional: two different values of an owl:FunctionalProperty. ``graph`` limits the data to one graph.
    """
    if graph is not None:
        data = data.filter(F.col("g") == graph)
    typed = (
        data.filter((F.col("p") == RDF_TYPE) & F.col("o_type").isin(*NODES))
        .select("s", F.col("o_value").alias("cls"))
    )
    stored = StoredGraph(schema)
    typed = infer_types(typed.unionByName(domain_range_types(data, domain_range_schema(stored))), subclass_closure(stored))
    pairs = (
        schema.filter(F.col("p") == OWL_DISJOINT)
        .select(F.least("s", "o_value").alias("cls"), F.greatest("s", "o_value").alias("_other")).distinct()
    )
    # From one class to its partner by two equi-joins; pairs of types of a node are never built.
    first = join_lookup(typed, pairs, ["cls"])
    second = typed.select("s", F.col("cls").alias("_other"))
    disjoint = first.join(second, ["s", "_other"], "left_semi").select(
        F.lit("disjoint").alias("kind"), "s", F.lit(RDF_TYPE).alias("p"), F.col("cls").alias("first"), F.col("_other").alias("second")
    )
    functional = (
        schema.filter((F.col("p") == RDF_TYPE) & (F.col("o_value") == OWL_FUNCTIONAL)).select(F.col("s").alias("p")).distinct()
    )
    value = F.struct(*OBJECT)
    conflicts = (
        join_lookup(data, functional, ["p"], "left_semi")
        .groupBy("s", "p").agg(F.min(value).alias("a"), F.max(value).alias("b"))
        .filter(F.col("a") != F.col("b"))
        .select(F.lit("functional").alias("kind"), "s", "p", F.col("a.o_value").alias("first"), F.col("b.o_value").alias("second"))
    )
    return disjoint.unionByName(conflicts)


def is_consistent(data: DataFrame, schema: DataFrame, graph: str | None = None) -> DataFrame:
    """One row, one boolean column ``consistent``."""
    found = contradictions(data, schema, graph).limit(1)
    return found.agg((F.count("*") == 0).alias("consistent"))
