"""Tables as graphs: declarative mappings from source rows to triples.

A mapping holds a source DataFrame and triple templates. A pattern with a constant predicate picks the templates it
can meet *before* any plan is built, so the scan reads only their columns and a filter on a value reaches the file.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.iri import SAFE_DIGITS, WHOLE_NUMBER, Template
from ..functions.terms import sql_term, value_of
from ..model import (
    DEFAULT_GRAPH,
    QUAD,
    RDF_TYPE,
    TERM_SCHEMA,
    XSD_STRING,
    Lit,
    Val,
    as_set,
    constant_object,
    is_var,
    node_term,
    term,
)
from .graph import EVERYTHING, Graph, Key, Pattern, constant_filters, from_terms, solutions, with_iris


@dataclass(frozen=True)
class Col:
    """A literal taken from a column; the datatype follows the column type unless given."""

    name: str
    datatype: str | None = None
    lang: str = ""


@dataclass(frozen=True)
class Rule:
    """One triple per source row. ``o`` is a Template, a Col, a Lit, or an IRI."""

    s: Template
    p: str
    o: object


@dataclass(frozen=True)
class Mapping:
    """Rules over one source.

    ``unique`` states that no two rows give the same subject (a key is in the template). Then the triples are
    distinct as they come, and a star of rules is one scan of the source. Leave it False when not sure.
    """

    source: DataFrame
    rules: tuple[Rule, ...]
    graph: str = DEFAULT_GRAPH
    unique: bool = False
    name: str = field(default="", compare=False)

    def with_graph(self, graph: str) -> Mapping:
        return replace(self, graph=graph)


def columns_of(x) -> list[str]:
    if isinstance(x, Template):
        return x.columns
    return [x.name] if isinstance(x, Col) else []


def object_parts(o, schema: T.StructType) -> tuple[Column, Column, Column, Column]:
    """value, type, datatype, lang of a rule's object as columns of the source."""
    lit = F.lit
    if isinstance(o, Template):
        return o.column(schema), lit("bnode" if o.bnode else "uri"), lit(""), lit("")
    if isinstance(o, Col):
        text, datatype = sql_term(F.col(f"`{o.name}`"), schema[o.name].dataType)
        if o.datatype is not None:
            datatype = "" if o.datatype == XSD_STRING else o.datatype
        return text, lit("literal"), lit("" if o.lang else datatype), lit(o.lang)
    c = constant_object(o)
    return lit(c["o_value"]), lit(c["o_type"]), lit(c["o_datatype"]), lit(c["o_lang"])


def is_node(o) -> bool:
    return isinstance(o, (Template, str))


def direct_value(o, schema: T.StructType, as_type: str) -> Column | None:
    """The native value of a rule's object straight from its column, when types allow; else None."""
    if not isinstance(o, Col) or o.lang:
        return None
    kind, col = schema[o.name].dataType, F.col(f"`{o.name}`")
    if o.datatype is not None:
        return None
    if as_type == "double" and isinstance(kind, T.NumericType):
        return col if isinstance(kind, T.DoubleType) else col.cast("double")
    if as_type == "long" and isinstance(kind, T.IntegralType):
        return col if isinstance(kind, T.LongType) else col.cast("long")
    if as_type == "string" and isinstance(kind, T.StringType):
        return col
    if as_type == "timestamp" and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return col if isinstance(kind, T.TimestampType) else col.cast("timestamp")
    if as_type == "date" and isinstance(kind, T.DateType):
        return col
    if as_type == "boolean" and isinstance(kind, T.BooleanType):
        return col
    return None


def exact_value(wanted, o, schema: T.StructType) -> bool:
    """Whether equal solutions of one rule are equal triples. Of native values, only doubles can hide a difference."""
    if not isinstance(wanted, Val):
        return True
    return wanted.as_type != "double" and direct_value(o, schema, wanted.as_type) is not None


def object_condition(o, wanted, schema: T.StructType) -> Column | bool:
    """Condition on the source for ``object = wanted``; True or False when it does not depend on the row."""
    if isinstance(o, Template):
        hit = o.matches(wanted, schema) if isinstance(wanted, str) else None
        return False if hit is None else hit
    if isinstance(o, Col):
        if not isinstance(wanted, Lit):
            return False
        kind, col = schema[o.name].dataType, F.col(f"`{o.name}`")
        text, datatype = sql_term(col, kind)
        if o.datatype is not None:
            datatype = "" if o.datatype == XSD_STRING else o.datatype
        if wanted.datatype != ("" if o.lang else datatype) or wanted.lang != o.lang:
            return False
        if o.datatype is None and isinstance(kind, T.IntegralType):
            if not re.fullmatch(WHOLE_NUMBER, wanted.value):
                return False
            return col == int(wanted.value) if len(wanted.value) <= SAFE_DIGITS else text == wanted.value
        return text == wanted.value
    return constant_object(o) == constant_object(wanted)


def bare_key(template, schema: T.StructType) -> Key | None:
    """The key of an IRI template over one number or text column."""
    if not isinstance(template, Template) or len(template.columns) != 1:
        return None
    kind = schema[template.columns[0]].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType)):
        return None
    return Key(template.head, template.parts[-1], isinstance(kind, T.IntegralType))


def apart(a: Rule, b: Rule) -> bool:
    """True when two rules can never give the same triple: other predicate, or subjects with unlike heads."""
    if a.p != b.p:
        return True
    x, y = a.s.head, b.s.head
    return not (x.startswith(y) or y.startswith(x))


class MappedGraph(Graph):
    """The virtual graph of some mappings; nothing is written."""

    def __init__(self, mappings: list[Mapping]):
        self.mappings = list(mappings)

    def candidates(self, pattern: Pattern, dataset) -> list[tuple[Mapping, Rule, list[Column]]]:
        out = []
        for m in self.mappings:
            if not dataset.may_use(m.graph, pattern):
                continue
            schema = m.source.schema
            for rule in m.rules:
                if not is_var(pattern.p) and pattern.p != rule.p:
                    continue
                conditions = [F.col(f"`{c}`").isNotNull() for c in dict.fromkeys(columns_of(rule.s) + columns_of(rule.o))]
                if not is_var(pattern.s):
                    hit = rule.s.matches(pattern.s, schema)
                    if hit is None:
                        continue
                    conditions.append(hit)
                if pattern.object_var is None:
                    hit = object_condition(rule.o, pattern.o, schema)
                    if hit is False:
                        continue
                    if hit is not True:
                        conditions.append(hit)
                out.append((m, rule, conditions))
        return out

    def match(self, pattern, nodes=frozenset(), dataset=EVERYTHING):
        return with_iris(*self.match_keys(pattern, nodes, dataset))

    def match_keys(self, pattern, nodes=frozenset(), dataset=EVERYTHING):
        found = self.candidates(pattern, dataset)
        rules = [r for _, r, _ in found]
        if not found:
            return self._nothing(pattern, nodes), {}
        unlike = all(apart(a, b) for i, a in enumerate(rules) for b in rules[i + 1 :])
        if is_var(pattern.p) and len({id(m) for m, _, _ in found}) < len(found):
            return self._match_all(found, pattern, nodes, unlike and all(m.unique for m, _, _ in found)), {}
        if unlike and all(m.unique or exact_value(pattern.o, r.o, m.source.schema) for m, r, _ in found):
            # No two rules share a triple. Within a rule, equal bare keys and values are equal triples, and shorter to
            # compare than IRIs; a unique mapping has no equal triples at all.
            parts = []
            for m, rule, conditions in found:
                solved = self._solve(m, [(pattern, rule)], conditions, nodes)
                if solved is not None:
                    parts.append(solved if m.unique else (as_set(solved[0]), solved[1]))
            return self._together(parts) if parts else (self._nothing(pattern, nodes), {})
        plain = Pattern(pattern.s, pattern.p, pattern.object_var or pattern.o, pattern.graph)
        parts = [self._solve(m, [(plain, r)], c, frozenset()) for m, r, c in found]
        df, keys = self._together(parts)
        return from_terms(as_set(with_iris(df, keys)), pattern, nodes), {}

    @staticmethod
    def _together(parts):
        """Union of solutions; a column stays a bare key when it is the same key in all parts."""
        first = parts[0][1]
        keys = {c: k for c, k in first.items() if all(p[1].get(c) == k for p in parts)}
        frames = [with_iris(df, mine, [c for c in mine if c not in keys]) for df, mine in parts]
        return reduce(DataFrame.unionByName, frames), keys

    def _match_all(self, found, pattern: Pattern, nodes: frozenset[str], distinct: bool) -> DataFrame:
        """A variable predicate: all rules of a source from one scan."""
        groups: dict[int, tuple[Mapping, list[Rule]]] = {}
        for m, rule, _ in found:
            groups.setdefault(id(m), (m, []))[1].append(rule)
        parts = []
        for m, rules in groups.values():
            source = m.source
            if not is_var(pattern.s) and len({r.s for r in rules}) == 1:
                source = source.filter(rules[0].s.matches(pattern.s, source.schema))
            quads_ = mapped_quads(replace(m, source=source, rules=tuple(rules)))
            parts.append(reduce(DataFrame.filter, constant_filters(pattern), quads_))
        every = reduce(DataFrame.unionByName, parts)
        if not distinct:
            every = as_set(every if pattern.graph is not None else every.drop("g"))
        return solutions(every, pattern, nodes)

    def _only(self, predicates) -> MappedGraph | None:
        """The rules with some predicates alone; None when there is none."""
        wanted = set(predicates)
        chosen = [replace(m, rules=tuple(r for r in m.rules if r.p in wanted)) for m in self.mappings]
        chosen = [m for m in chosen if m.rules]
        return MappedGraph(chosen) if chosen else None

    def statements(self, predicates, dataset=EVERYTHING):
        pattern = Pattern("?s", "?p", "?o")
        some = self._only(predicates)
        return (self._nothing(pattern, frozenset()) if some is None else some.match(pattern, frozenset(), dataset)).select("s", "p", "o")

    def match_any(self, pattern, names, dataset=EVERYTHING):
        # Only the predicates of its own rules come to the driver, so the mapping bounds them.
        known = sorted({r.p for m in self.mappings for r in m.rules})
        wanted = [r["p"] for r in names.filter(F.col("p").isin(known)).select("p").distinct().collect()]
        plain = Pattern(pattern.s, "?_p", pattern.object_var or pattern.o, pattern.graph)
        some = self._only(wanted)
        found = self._nothing(plain, frozenset()) if some is None else some.match(plain, frozenset(), dataset)
        return as_set(found.drop("_p"))

    def match_star(self, patterns, nodes, dataset):
        """One scan for patterns ``?s p1 o1 . ?s p2 o2 ...`` when one unique mapping alone can answer all of them."""
        subject, graph = patterns[0].s, patterns[0].graph
        if not is_var(subject) or any(is_var(p.p) or p.graph != graph for p in patterns) or is_var(graph):
            return None
        chosen, conditions, source = [], [], None
        for p in patterns:
            found = self.candidates(p, dataset)
            if source is not None:
                # Only rules that can share a subject with the source chosen first matter.
                found = [f for f in found if not apart(Rule(f[1].s, "", None), Rule(chosen[0][1].s, "", None))]
            if len(found) != 1:
                return None
            mapping, rule, conds = found[0]
            if not mapping.unique or (source is not None and mapping is not source):
                return None
            if chosen and rule.s != chosen[0][1].s:
                return None
            source = mapping
            chosen.append((p, rule))
            conditions += conds
        return self._solve(source, chosen, conditions, nodes)

    def _solve(self, mapping: Mapping, chosen, conditions: list[Column], nodes: frozenset[str]):
        """Solutions of patterns, each bound to one rule, on a row of the source, and their bare keys.

        None when no row can match.
        """
        schema = mapping.source.schema
        for p, _ in chosen:
            nodes = nodes | frozenset(p.node_variables)
        conditions = list(conditions)
        columns: dict[str, Column] = {}
        keys: dict[str, Key] = {}

        def iri_of(var):
            return keys[var].iri(columns[var]) if var in keys else columns[var]

        def bind(var, column, template=None):
            if var in columns:
                conditions.append(iri_of(var) == column)
                return
            key = bare_key(template, schema)
            if key is not None:
                keys[var], column = key, F.col(f"`{template.columns[0]}`")
                column = column.cast("long") if key.number else column
            columns[var] = column

        for p, rule in chosen:
            if is_var(p.s) and p.s not in columns:
                bind(p.s, rule.s.column(schema), rule.s)
            if is_var(p.p):
                bind(p.p, F.lit(rule.p))
            if is_var(p.graph):
                bind(p.graph, F.lit(mapping.graph))
            var = p.object_var
            if var is None:
                continue
            value, type_, datatype, lang = object_parts(rule.o, schema)
            if isinstance(p.o, Val):
                native = direct_value(rule.o, schema, p.o.as_type)
                if native is None:
                    native = value_of(type_, value, datatype, p.o.as_type)
                conditions.append(native.isNotNull())
                bind(var, native)
            elif var in nodes:
                if not is_node(rule.o):
                    return None
                bind(var, value, rule.o if isinstance(rule.o, Template) else None)
            else:
                bind(var, term(type_, value, datatype, lang))
        df = reduce(DataFrame.filter, conditions, mapping.source)
        return df.select(*[c.alias(v[1:]) for v, c in columns.items()]), {v[1:]: k for v, k in keys.items()}

    def _nothing(self, pattern: Pattern, nodes: frozenset[str]) -> DataFrame:
        spark = self.mappings[0].source.sparkSession
        nodes = nodes | frozenset(pattern.node_variables)
        fields = []
        for v in pattern.variables:
            kind: T.DataType = T.StringType() if v in nodes else TERM_SCHEMA
            if isinstance(pattern.o, Val) and v == pattern.o.var:
                kind = T._parse_datatype_string(pattern.o.as_type)
            fields.append(T.StructField(v[1:], kind))
        return spark.createDataFrame([], T.StructType(fields))

    def quads(self):
        """All quads: one scan per mapping, however many rules it has."""
        parts, distinct = [], True
        for m in self.mappings:
            parts.append(mapped_quads(m))
            distinct = distinct and m.unique and all(
                apart(a, b) for i, a in enumerate(m.rules) for b in m.rules[i + 1 :]
            )
        for i, m in enumerate(self.mappings):
            for n in self.mappings[i + 1 :]:
                distinct = distinct and (m.graph != n.graph or all(apart(a, b) for a in m.rules for b in n.rules))
        every = reduce(DataFrame.unionByName, parts)
        return every if distinct else as_set(every)


def mapped_quads(mapping: Mapping) -> DataFrame:
    """Quads of one mapping, row by row, duplicates kept. A NULL column makes no triple."""
    schema = mapping.source.schema
    rows = []
    for rule in mapping.rules:
        value, type_, datatype, lang = object_parts(rule.o, schema)
        parts = (rule.s.column(schema), F.lit(rule.p), value, type_, datatype, lang, F.lit(mapping.graph))
        rows.append(F.struct(*[c.cast("string").alias(n) for c, n in zip(parts, QUAD)]))
    if len(rows) == 1:
        out = mapping.source.select(*[rows[0][n].alias(n) for n in QUAD])
    else:
        out = mapping.source.select(F.inline(F.array(*rows)))
    return out.filter(F.col("s").isNotNull() & F.col("o_value").isNotNull())


#: Equal rows that are numbered from one array.
NUMBERED = 10_000


@dataclass(frozen=True)
class Table:
    """A relational source for direct mapping: name, data, primary key and foreign keys ``column -> (table, key)``."""

    name: str
    data: DataFrame
    key: tuple[str, ...] = ()
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)


def row_template(table: str, base: str, columns: list[tuple[str, str]]) -> Template:
    """``base/Table/key=value``, several key parts joined by ';'."""
    return Template(f"{base}{table}/" + ";".join(f"{k}={{{c}}}" for k, c in columns))


def direct_mapping(tables: list[Table], base: str, columns: dict[str, list[str]] | None = None, graph: str = DEFAULT_GRAPH) -> MappedGraph:
    """The mapping that needs no mapping text.

    Per row: one ``rdf:type``, one literal per non-NULL column, one link per foreign key. The subject is
    ``base/Table/key=value``; a row without a key is a blank node named by a hash of the whole row and, for the second and further of
    equal rows, its number. ``columns`` limits the mapped columns of a table.
    """
    mappings = []
    for t in tables:
        source = t.data
        if t.key:
            subject = row_template(t.name, base, [(k, k) for k in t.key])
        else:
            # Equal rows are counted, which merges them on the map side, and numbered from the count, in steps that keep arrays short.
            names = source.columns
            source = source.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias("_n"))
            source = source.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / NUMBERED))))
            last = F.least(F.col("_n"), (F.col("_step") + 1) * NUMBERED)
            source = source.withColumn("_number", F.explode(F.sequence(F.col("_step") * NUMBERED + 1, last)))
            row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])), 256)
            source = source.withColumn("_row", F.when(F.col("_number") == 1, row).otherwise(F.concat(row, F.lit("-"), F.col("_number"))))
            subject = Template(f"{t.name}{{_row}}", bnode=True)
        wanted = (columns or {}).get(t.name, t.data.columns)
        rules = [Rule(subject, RDF_TYPE, f"{base}{t.name}")]
        rules += [Rule(subject, f"{base}{t.name}#{c}", Col(c)) for c in wanted]
        for c, (other, key) in t.foreign.items():
            if c in wanted:
                rules.append(Rule(subject, f"{base}{t.name}#ref-{c}", row_template(other, base, [(key, c)])))
        mappings.append(Mapping(source, tuple(rules), graph, unique=True, name=t.name))
    return MappedGraph(mappings)


def node_or_term(col: Column, data_type: T.DataType, literal: bool = False) -> Column:
    """Any solution column as a term struct; native values take the datatype of their Spark type. Text is a node unless marked ``literal``."""
    if isinstance(data_type, T.StructType):
        return col
    if literal:
        return F.when(col.isNotNull(), term(F.lit("literal"), col))
    if isinstance(data_type, T.StringType):
        return node_term(col)
    text, datatype = sql_term(col, data_type)
    return term(F.lit("literal"), text, F.lit(datatype))
