"""Joins of patterns and the other parts of a graph query.

Every function takes and returns DataFrames of solutions. Joins carry no hints: the planner broadcasts a side by its
known size, and adaptive execution splits skewed keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import DEFAULT_GRAPH, OBJECT, QUAD, TERM_SCHEMA, Lit, Val, as_set, constant_object, is_var
from ..session import cut, dealt, join_lookup
from .graph import EVERYTHING, Dataset, Graph, Key, Pattern, with_iris


def order_patterns(patterns: list[Pattern]) -> list[Pattern]:
    """A connected order: most constants first, class patterns late, always sharing a variable with what is there."""
    from ..model import RDF_TYPE

    def weight(p: Pattern):
        return (-p.constants, p.p == RDF_TYPE)

    rest = sorted(patterns, key=weight)
    out, seen = [rest.pop(0)], set()
    seen |= set(out[0].variables)
    while rest:
        linked = [p for p in rest if seen & set(p.variables)]
        if not linked:
            raise ValueError("the patterns share no variable; their product is not built")
        nxt = linked[0]
        rest.remove(nxt)
        out.append(nxt)
        seen |= set(nxt.variables)
    return out


def bgp(graph: Graph, patterns: list[Pattern], dataset: Dataset = EVERYTHING) -> DataFrame:
    """Solutions of a basic graph pattern as a bag.

    Patterns with the same subject go to the graph as one star first; a mapped table answers it with one scan.
    Variables that stand in a subject, predicate or graph position anywhere are node columns everywhere. Patterns without
    variables only have to match; they are conditions on the rest.
    """
    fixed = [p for p in patterns if not p.variables]
    if fixed and len(fixed) < len(patterns):
        found = bgp(graph, [p for p in patterns if p.variables], dataset)
        return reduce(_if_any, [graph.match(p, frozenset(), dataset) for p in fixed], found)
    if len(fixed) > 1:
        return reduce(_if_any, [graph.match(p, frozenset(), dataset) for p in fixed[1:]], graph.match(fixed[0], frozenset(), dataset))
    nodes = frozenset(v for p in patterns for v in p.node_variables)
    stars: dict[tuple, list[Pattern]] = {}
    for p in patterns:
        stars.setdefault((p.s, p.graph), []).append(p)
    parts: list[tuple[Pattern, tuple[DataFrame, dict[str, Key]]]] = []
    single: list[Pattern] = []
    for group in stars.values():
        found = graph.match_star(group, nodes, dataset) if len(group) > 1 else None
        if found is None:
            single += group
        else:
            merged = sorted(group, key=lambda p: -p.constants)[0]
            parts.append((_Star(merged, tuple(v for p in group for v in p.variables)), found))
    parts += [(p, graph.match_keys(p, nodes, dataset)) for p in single]
    frames = {id(p): found for p, found in parts}
    ordered = order_patterns([p for p, _ in parts])
    return _marked(with_iris(*reduce(_join_keys, [frames[id(p)] for p in ordered])), patterns)


# Marks in the metadata of solution columns: never NULL; native text of literals, where text otherwise means a node.
BOUND, LITERAL = "bound", "literal"


def _marked(found: DataFrame, patterns: list[Pattern]) -> DataFrame:
    texts = {p.o.var[1:] for p in patterns if isinstance(p.o, Val) and p.o.as_type == "string"}
    return found.select(*[F.col(f"`{c}`").alias(c, metadata={BOUND: True} | ({LITERAL: True} if c in texts else {})) for c in found.columns])


def _if_any(found: DataFrame, condition: DataFrame) -> DataFrame:
    """``found`` if the condition has a row, else nothing. One row of the condition is enough."""
    one = condition.select(F.lit(1).alias("_one")).limit(1)
    return found.withColumn("_one", F.lit(1)).join(F.broadcast(one), ["_one"], "left_semi").drop("_one")


def _join_keys(left: tuple[DataFrame, dict[str, Key]], right: tuple[DataFrame, dict[str, Key]]):
    """Join where some columns are bare keys: equal keys join as they are, others as IRIs."""
    (l, l_keys), (r, r_keys) = left, right
    unlike = [c for c in l.columns if c in r.columns and l_keys.get(c) != r_keys.get(c)]
    l, r = with_iris(l, l_keys, unlike), with_iris(r, r_keys, unlike)
    l, r, shared = aligned(l, r)
    if not shared:
        raise ValueError("the patterns share no variable; their product is not built")
    return l.join(r, shared, "inner"), {c: k for c, k in {**l_keys, **r_keys}.items() if c not in unlike}


class _Star(Pattern):
    """Stands for a star of patterns while joins are ordered."""

    def __init__(self, first: Pattern, variables: tuple[str, ...]):
        super().__init__(first.s, first.p, first.o, first.graph)
        object.__setattr__(self, "_variables", tuple(dict.fromkeys(variables)))

    @property
    def variables(self):
        return list(self._variables)


def aligned(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Shared variables of two solutions, brought to one shape: a term that meets a node keeps only nodes."""
    shared = [c for c in left.columns if c in right.columns]
    for c in shared:
        l, r = left.schema[c].dataType, right.schema[c].dataType
        if isinstance(l, T.StructType) and isinstance(r, T.StringType):
            left = _to_node(left, c)
        elif isinstance(l, T.StringType) and isinstance(r, T.StructType):
            right = _to_node(right, c)
    return left, right, shared


def _to_node(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c)["type"].isin("uri", "bnode")).withColumn(c, F.col(c)["value"])


def _null_sets(df: DataFrame, shared: list[str]) -> list[frozenset]:
    """Which of the shared variables are unbound together in some row.

    Variables of a basic graph pattern are marked as bound and cost nothing; for others the sets that occur are counted.
    """
    doubtful = [c for c in shared if not df.schema[c].metadata.get(BOUND)]
    if not doubtful:
        return [frozenset()]
    seen = df.groupBy(*[F.col(c).isNull().alias(f"_{i}") for i, c in enumerate(doubtful)]).count().collect()
    return [frozenset(c for i, c in enumerate(doubtful) if r[f"_{i}"]) for r in seen] or [frozenset()]


def _with_nulls(df: DataFrame, shared: list[str], nulls: frozenset, sets: list[frozenset]) -> DataFrame:
    """The rows in which exactly ``nulls`` are unbound."""
    if sets == [nulls]:
        return df
    return df.filter(reduce(Column.__and__, [F.col(c).isNull() if c in nulls else F.col(c).isNotNull() for c in shared]))


def _split(left: DataFrame, right: DataFrame, shared: list[str]):
    """Both sides by the variables that are unbound in them; what is bound on both sides is joined by equality."""
    l_sets, r_sets = _null_sets(left, shared), _null_sets(right, shared)
    rights = [(r, _with_nulls(right, shared, r, r_sets)) for r in r_sets]
    for l in l_sets:
        yield l, _with_nulls(left, shared, l, l_sets), rights


def _met(left: DataFrame, right: DataFrame, shared: list[str], keys: list[str], how: str, condition: Column | None = None) -> DataFrame:
    """Join on ``keys``; the other shared variables take the value of the side that has one."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}" if c in shared else c) for c in right.columns])
    on = reduce(Column.__and__, [F.col(c) == F.col(f"_r_{c}") for c in keys])
    joined = left.join(renamed, on if condition is None else on & condition, how)
    filled = [F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if c in shared and c not in keys else F.col(f"`{c}`") for c in left.columns]
    return joined.select(*filled, *[F.col(f"`{c}`") for c in right.columns if c not in shared])


def _one_row(df: DataFrame) -> bool:
    return len(df.limit(2).collect()) < 2


def _product(left: DataFrame, right: DataFrame, shared: list[str], how: str, condition: Column | None = None) -> DataFrame:
    """Rows that share no bound variable all agree with each other. Built where one side is a row at most, and an error naming the variables otherwise.

    The one row is joined on a constant and broadcast; a left row without a partner is kept by asking whether there is any result.
    """
    few_right = _one_row(right)
    if not few_right and not _one_row(left):
        raise ValueError(f"rows share no bound variable ({', '.join('?' + c for c in shared)} unbound); their product is not built")
    l, r = left.withColumn("_k", F.lit(1)), right.select(*[F.col(f"`{c}`").alias(f"_r_{c}" if c in shared else c) for c in right.columns]).withColumn("_k", F.lit(1))
    on = (l["_k"] == r["_k"]) if condition is None else (l["_k"] == r["_k"]) & condition
    filled = [F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) if c in shared else F.col(f"`{c}`") for c in left.columns]
    columns = [*filled, *[F.col(f"`{c}`") for c in right.columns if c not in shared]]
    if few_right and how != "left_anti":
        return l.join(F.broadcast(r), on, how).select(*columns)
    if few_right:
        return l.join(F.broadcast(r), on, how).drop("_k")
    met = F.broadcast(l).join(r, on, "inner").select(*columns)
    if how == "inner":
        return met
    alone = l.join(F.broadcast(met.select(F.lit(1).alias("_k")).limit(1)), ["_k"], "left_anti").drop("_k")
    if how == "left_anti":
        return alone
    kinds = {f.name: f.dataType for f in right.schema}
    return met.unionByName(alone.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in right.columns if c not in shared]))


def join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on all shared variables; an unbound (NULL) variable agrees with any value. Without columns a side only has to match."""
    if not right.columns:
        return _if_any(left, right)
    if not left.columns:
        return _if_any(right, left)
    left, right, shared = aligned(left, right)
    if not shared:
        raise ValueError("the two sides share no variable; their product is not built")
    parts = []
    for l, lefts, rights in _split(left, right, shared):
        for r, found in rights:
            keys = [c for c in shared if c not in l | r]
            if not keys:
                parts.append(_product(lefts, found, shared, "inner"))
            else:
                parts.append(lefts.join(found, shared, "inner") if len(keys) == len(shared) else _met(lefts, found, shared, keys, "inner"))
    return reduce(DataFrame.unionByName, parts)


def optional(left: DataFrame, right: DataFrame, condition: Column | None = None) -> DataFrame:
    """OPTIONAL: a left row without partner keeps NULL for the right variables; an unbound variable takes the right value."""
    left, right, shared = _aligned_keeping_left(left, right)
    if not shared:
        raise ValueError("the two sides share no variable; their product is not built")
    more = [c for c in right.columns if c not in shared]
    parts = []
    for l, lefts, rights in _split(left, right, shared):
        keyed = [([c for c in shared if c not in l | r], found) for r, found in rights]
        if len(keyed) == 1 and not keyed[0][0]:
            parts.append(_product(lefts, keyed[0][1], shared, "left", condition))
            continue
        if len(keyed) == 1:
            keys, found = keyed[0]
            parts.append(lefts.join(found, shared, "left") if len(keys) == len(shared) and condition is None else _met(lefts, found, shared, keys, "left", condition))
            continue
        # Several kinds of right rows: partners of each kind, and the left rows that have none of any kind.
        alone = lefts
        for keys, found in keyed:
            if not keys:
                parts.append(_product(lefts, found, shared, "inner", condition))
                alone = _product(alone, found, shared, "left_anti", condition)
                continue
            parts.append(_met(lefts, found, shared, keys, "inner", condition))
            renamed = found.select(*[F.col(f"`{c}`").alias(f"_r_{c}" if c in shared else c) for c in found.columns])
            on = reduce(Column.__and__, [F.col(c) == F.col(f"_r_{c}") for c in keys])
            alone = alone.join(renamed, on if condition is None else on & condition, "left_anti")
        kinds = {f.name: f.dataType for f in right.schema}
        parts.append(alone.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in more]))
    found = reduce(DataFrame.unionByName, parts)
    # What comes from the right may be unbound from here on.
    marks = {c: {k: v for k, v in found.schema[c].metadata.items() if k != BOUND} for c in more}
    return found.select(*[F.col(f"`{c}`").alias(c, metadata=marks[c]) if c in more else F.col(f"`{c}`") for c in found.columns])


def _aligned_keeping_left(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """As :func:`aligned`, but no left row is lost: a node on the left becomes a term when the right has terms."""
    from ..model import node_term

    shared = [c for c in left.columns if c in right.columns]
    for c in shared:
        l, r = left.schema[c].dataType, right.schema[c].dataType
        if isinstance(l, T.StringType) and isinstance(r, T.StructType):
            right = _to_node(right, c)
        elif isinstance(l, T.StructType) and isinstance(r, T.StringType):
            right = right.withColumn(c, F.when(F.col(c).isNotNull(), node_term(F.col(c))))
    return left, right, shared


def join_compatible(left: DataFrame, right: DataFrame, maybe_unbound: str) -> DataFrame:
    """:func:`join` for a variable that must be shared."""
    if maybe_unbound not in left.columns or maybe_unbound not in right.columns:
        raise ValueError(f"{maybe_unbound} is not shared by both sides")
    return join(left, right)


def _partnered(left: DataFrame, right: DataFrame, shared: list[str], without_keys: bool) -> tuple[DataFrame, DataFrame]:
    """Left rows with a compatible right row, and those without one.

    ``without_keys`` says whether rows that have no bound variable in common count as compatible.
    """
    some, none = [], []
    for l, rest, rights in _split(left, right, shared):
        for r, found in rights:
            keys = [c for c in shared if c not in l | r]
            if keys:
                some.append(rest.join(found.select(*keys), keys, "left_semi"))
                rest = rest.join(found.select(*keys), keys, "left_anti")
            elif without_keys:
                one = found.select(F.lit(1).alias("_one")).limit(1)
                marked = rest.withColumn("_one", F.lit(1))
                some.append(marked.join(F.broadcast(one), ["_one"], "left_semi").drop("_one"))
                rest = marked.join(F.broadcast(one), ["_one"], "left_anti").drop("_one")
        none.append(rest)
    return reduce(DataFrame.unionByName, some) if some else left.limit(0), reduce(DataFrame.unionByName, none)


def exists(left: DataFrame, right: DataFrame) -> DataFrame:
    """FILTER EXISTS on the shared variables; unbound ones agree with any value."""
    left, right, shared = _aligned_keeping_left(left, right)
    return _partnered(left, right, shared, True)[0].select(*left.columns) if shared else _if_any(left, right)


def not_exists(left: DataFrame, right: DataFrame) -> DataFrame:
    """FILTER NOT EXISTS on the shared variables; unbound ones agree with any value."""
    left, right, shared = _aligned_keeping_left(left, right)
    if not shared:
        one = right.select(F.lit(1).alias("_one")).limit(1)
        return left.withColumn("_one", F.lit(1)).join(F.broadcast(one), ["_one"], "left_anti").drop("_one")
    return _partnered(left, right, shared, True)[1].select(*left.columns)


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """MINUS: like NOT EXISTS, but a row is only taken away by one that shares a bound variable with it."""
    left, right, shared = _aligned_keeping_left(left, right)
    return _partnered(left, right, shared, False)[1].select(*left.columns) if shared else left


def values(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """VALUES: an inline table. Text is a node, ``Lit`` a term, None is unbound; other values stay native."""
    columns = list(zip(*rows))
    fields, data = [], []
    for name, column in zip(names, columns):
        known = [x for x in column if x is not None]
        if any(isinstance(x, Lit) for x in known):
            fields.append(T.StructField(name, TERM_SCHEMA))
            data.append([None if x is None else _term_tuple(x) for x in column])
        else:
            kind = T.StringType()
            if known and isinstance(known[0], bool):
                kind = T.BooleanType()
            elif known and isinstance(known[0], int):
                kind = T.LongType()
            elif known and isinstance(known[0], float):
                kind = T.DoubleType()
            fields.append(T.StructField(name, kind))
            data.append(list(column))
    return spark.createDataFrame(list(zip(*data)), T.StructType(fields))


def _term_tuple(x):
    c = constant_object(x)
    return (c["o_type"], c["o_value"], c["o_datatype"], c["o_lang"])


def join_values(left: DataFrame, inline: DataFrame) -> DataFrame:
    """Join with an inline table; broadcast only if its measured size is small."""
    left, inline, shared = aligned(left, inline)
    if not shared:
        raise ValueError("the inline table shares no variable; its product is not built")
    return join_lookup(left, inline, shared)


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION as a bag; variables of one side only are unbound (NULL) on the other."""
    from ..model import node_term
    from .mapping import node_or_term

    for c in [c for c in left.columns if c in right.columns]:
        l, r = left.schema[c].dataType, right.schema[c].dataType
        if isinstance(l, T.StructType) and isinstance(r, T.StringType):
            right = right.withColumn(c, node_term(F.col(c)))
        elif isinstance(l, T.StringType) and isinstance(r, T.StructType):
            left = left.withColumn(c, node_term(F.col(c)))
        elif isinstance(l, T.StringType) and bool(left.schema[c].metadata.get(LITERAL)) != bool(right.schema[c].metadata.get(LITERAL)):
            left, right = (d.withColumn(c, node_or_term(F.col(c), T.StringType(), bool(d.schema[c].metadata.get(LITERAL)))) for d in (left, right))
    both = left.unionByName(right, allowMissingColumns=True)
    open_ = [c for c in both.columns if not all(c in d.columns and d.schema[c].metadata.get(BOUND) for d in (left, right))]
    keep = {c: {k: v for k, v in both.schema[c].metadata.items() if k != BOUND} for c in open_}
    return both.select(*[F.col(f"`{c}`").alias(c, metadata=keep[c]) if c in open_ else F.col(f"`{c}`") for c in both.columns])


def bind_params(patterns: list[Pattern], bindings: dict[str, object]) -> list[Pattern]:
    """Replace variables by given terms before matching, so they act as constants. Replaced variables are not projected."""

    def swap(x):
        if isinstance(x, Val):
            return bindings.get(x.var[1:], x)
        return bindings.get(x[1:], x) if is_var(x) else x

    return [Pattern(swap(p.s), swap(p.p), swap(p.o), swap(p.graph) if p.graph else None) for p in patterns]


def ask(solutions: DataFrame) -> DataFrame:
    """One row, one boolean column ``answer``: is there a solution. Reads no more than it takes to find one."""
    one = solutions.select(F.lit(1).alias("one")).limit(1)
    return one.agg((F.count("*") > 0).alias("answer"))


def construct(solutions: DataFrame, template: list[Pattern], graph: str = DEFAULT_GRAPH) -> DataFrame:
    """Quads of a template per solution, as a set. Rows with an unbound part or a literal subject make no triple.

    A blank node of the template (``_:b``) is a new one for every solution. Text that a ``Val`` has read is a literal.
    Solutions are dealt out before quads are made of them and made distinct: they may come from one task that has read a large row group.
    """
    schema = {f.name: f.dataType for f in solutions.schema}
    literal = {f.name for f in solutions.schema if f.metadata.get(LITERAL)}
    solution = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(solutions.columns)])))

    def node(x) -> Column:
        if not is_var(x):
            return F.concat(F.lit(x + "-"), solution) if x.startswith("_:") else F.lit(x)
        if x[1:] in literal:
            return F.lit(None).cast("string")
        col, kind = F.col(x[1:]), schema[x[1:]]
        if isinstance(kind, T.StructType):
            return F.when(col["type"].isin("uri", "bnode"), col["value"])
        if isinstance(kind, T.StringType):
            return col
        return F.lit(None).cast("string")

    def obj(x) -> list[Column]:
        var = x.var if isinstance(x, Val) else x
        if isinstance(x, str) and x.startswith("_:"):
            return [node(x), F.lit("bnode"), F.lit(""), F.lit("")]
        if is_var(var):
            from .mapping import node_or_term

            t = node_or_term(F.col(var[1:]), schema[var[1:]], var[1:] in literal)
            return [t["value"], t["type"], t["datatype"], t["lang"]]
        c = constant_object(x)
        return [F.lit(c[k]) for k in OBJECT]

    parts = [x.var if isinstance(x, Val) else x for t in template for x in (t.s, t.p, t.o, t.graph)]
    solutions = dealt(solutions, sorted({x[1:] for x in parts if is_var(x)}))
    rows = []
    for t in template:
        g = F.lit(graph) if t.graph is None else node(t.graph)
        parts = [node(t.s), node(t.p), *obj(t.o), g]
        rows.append(F.struct(*[c.alias(n) for c, n in zip(parts, QUAD)]))
    made = solutions.select(F.inline(F.array(*rows))) if len(rows) > 1 else solutions.select(rows[0].alias("q")).select("q.*")
    made = made.filter(F.col("s").isNotNull() & F.col("p").isNotNull() & F.col("o_value").isNotNull() & F.col("g").isNotNull())
    return as_set(made.filter(~F.col("p").startswith("_:")))


def list_graphs(graph: Graph) -> DataFrame:
    """Names of non-empty named graphs."""
    return graph.quads().filter(F.col("g") != DEFAULT_GRAPH).select("g").distinct()


def topk(solutions: DataFrame, order: list, k: int) -> DataFrame:
    """The first ``k`` rows; rows that are equal in ``order`` follow the remaining columns. Each task keeps its ``k`` best."""
    return solutions.orderBy(*_total(solutions, order)).limit(k)


def page(solutions: DataFrame, order: list, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Sort, skip, take; rows that are equal in ``order`` follow the remaining columns.

    Rows are placed by a range-partitioned sort, which is written with ids that hold the range and the place in it. Rows
    of ranges are added up over the ranges, and the two ids between which the page lies are the only values that reach the driver.
    """
    if limit is None and not offset:
        return solutions.orderBy(*_total(solutions, order))
    placed = cut(solutions.orderBy(*_total(solutions, order)).withColumn("_id", F.monotonically_increasing_id()), "page")
    sizes = placed.groupBy(F.shiftright("_id", 33).alias("r")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("r")) - F.col("n")
    low, high = offset, offset + limit if limit is not None else None
    begin = F.when((before <= low) & (before + F.col("n") > low), F.shiftleft("r", 33) + (F.lit(low) - before))
    end = F.lit(None).cast("long") if high is None else F.when((before < high) & (before + F.col("n") >= high), F.shiftleft("r", 33) + (F.lit(high) - before - 1))
    found = sizes.select(begin.alias("begin"), end.alias("end")).agg(F.max("begin").alias("begin"), F.max("end").alias("end")).first()
    if found["begin"] is None or limit == 0:
        return solutions.limit(0)
    inside = F.col("_id") >= found["begin"]
    if found["end"] is not None:
        inside = inside & (F.col("_id") <= found["end"])
    return placed.filter(inside).orderBy("_id").drop("_id")


def _total(solutions: DataFrame, order: list) -> list:
    """The order, with all other columns that can be compared behind it."""
    named = {o for o in order if isinstance(o, str)}
    more = [f.name for f in solutions.schema if f.name not in named and not isinstance(f.dataType, T.MapType)]
    return [*order, *[F.col(f"`{c}`") for c in more]]


__all__ = [
    "bgp", "join", "optional", "join_compatible", "exists", "not_exists", "minus", "values", "join_values", "union",
    "bind_params", "ask", "construct", "list_graphs", "page", "topk",
]
