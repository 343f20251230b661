"""Closed-world constraints: which stored values break which shape.

Constraints are a table. The statements with a constrained path are read once and joined with it by path, the types once and joined with
it by class, however many constraints there are. What depends on one value is a column of that row; counts, domains and subclasses are columns
over the group of a node and constraint. A check returns ``(shape, focus, path, value, kind)``; ``value`` is '' where the fault is a
missing or surplus value as such.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.terms import value_of
from ..model import RDF_TYPE, XSD_BOOLEAN, XSD_DATE, XSD_DATETIME, constant_object
from ..session import SALTS, cut, fits_broadcast, join_lookup
from .graph import EVERYTHING, Dataset, Graph, Pattern
from .patterns import page
from .reasoning import ReasonedGraph

COLUMNS = ["shape", "focus", "path", "value", "kind"]
KINDS = ("min", "max", "class", "datatype", "domain", "in", "subclass", "pattern")

# Options of a report.
REPORT_OPTIONS = (
    "shapes",
    "shacl.shape.graphs",
    "nodes",
    "countLimit",
    "shacl.targetClass.simple",
    "shacl.violation.limit.shape",
    "graph-uri",
    "reasoning",
)


@dataclass(frozen=True)
class Shape:
    """One constraint.

    min, max: instances of ``target_class`` have at least / at most ``arg`` values of ``path``; without a target class
    ``max`` holds for every subject. class, datatype: values of ``path`` are instances of class ``arg`` / literals of
    datatype ``arg``. domain: subjects of ``path`` are instances of ``arg``. in: values of ``path`` are in the list
    ``arg``. subclass: instances of ``target_class`` are also stored as instances of ``arg``. pattern: the text of
    values of ``path`` matches the regular expression ``arg``. ``graph`` is the shape graph the constraint belongs to.
    """

    name: str
    kind: str
    path: str = ""
    arg: object = None
    target_class: str = ""
    graph: str = ""

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind of constraint: {self.kind}")


class Validation:
    """Checks a graph against constraints.

    ``follow_subclasses`` lets targets and class checks see instances of subclasses too; otherwise stored types alone
    count. ``nodes`` limits the check to given focus nodes, given as a list or a DataFrame with a column ``focus``.
    """

    def __init__(self, graph: Graph, shapes: list[Shape], closure: DataFrame | None = None,
                 nodes: DataFrame | list[str] | None = None, dataset: Dataset = EVERYTHING):
        self.graph, self.shapes, self.dataset, self.closure = graph, list(shapes), dataset, closure
        self.spark: SparkSession = SparkSession.active()
        self.nodes = None
        if nodes is not None:
            listed = isinstance(nodes, list)
            self.nodes = self.spark.createDataFrame([(n,) for n in nodes], "focus string") if listed else nodes.select("focus")
            self.nodes = cut(self.nodes.distinct())
            self._small_nodes = fits_broadcast(self.nodes)
        self._small_closure = closure is not None and fits_broadcast(closure)

    def _of(self, *kinds: str) -> list[Shape]:
        return [s for s in self.shapes if s.kind in kinds]

    def _focus_only(self, df: DataFrame, column: str) -> DataFrame:
        if self.nodes is None:
            return df
        return join_lookup(df, self.nodes.withColumnRenamed("focus", column), [column], "left_semi", small=self._small_nodes)

    def _table(self) -> DataFrame:
        """The constraints as rows, numbered."""
        rows = []
        for i, s in enumerate(self.shapes):
            terms = [constant_object(x) for x in s.arg] if s.kind == "in" else []
            terms = [(t["o_type"], t["o_value"], t["o_datatype"], t["o_lang"]) for t in terms]
            rows.append((i, s.name, s.kind, s.path, s.target_class, int(s.arg) if s.kind in ("min", "max") else None,
                         s.arg if s.kind in ("class", "datatype", "domain", "subclass", "pattern") else None, terms))
        schema = "id int, shape string, kind string, path string, target string, n long, arg string, allowed array<struct<type:string,value:string,datatype:string,lang:string>>"
        # Made of values in Python, so it is small; joined by a shuffle, all statements of a path would meet in one task.
        return F.broadcast(self.spark.createDataFrame(rows, schema))

    def _roles(self, table: DataFrame) -> DataFrame:
        """``(cls, id, role)``: which classes make a node a target of a constraint, and which a member of the class it asks for."""
        targets = table.filter((F.col("target") != "") & F.col("kind").isin("min", "max", "subclass")).select(F.col("target").alias("cls"), "id", "kind", F.lit("target").alias("role"))
        members = table.filter(F.col("kind").isin("class", "domain", "subclass")).select(F.col("arg").alias("cls"), "id", "kind", F.lit("member").alias("role"))
        roles = targets.unionByName(members)
        if self.closure is not None:
            up = self.closure.select(F.col("super").alias("cls"), F.col("sub").alias("_sub"))
            more = roles.filter("kind <> 'subclass'").join(up, "cls").withColumn("cls", F.col("_sub")).drop("_sub")  # that one is about stored types
            roles = roles.unionByName(more.select(*roles.columns)).distinct()
        return roles.select("cls", "id", "role")

    def violations(self) -> DataFrame:
        """All violations of all kinds: the statements of all paths are read once, and so are the types."""
        if not self.shapes:
            return self.spark.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS))
        table = self._table()
        grouped, single = self._of("min", "max", "domain", "subclass"), self._of("class", "datatype", "in", "pattern")
        paths = sorted({s.path for s in self.shapes if s.kind != "subclass"})
        with_types = [s for s in self.shapes if s.target_class or s.kind in ("class", "domain", "subclass")]
        values = types = None
        if paths:
            values = self._focus_only(self.graph.statements(paths, self.dataset).select(F.col("s").alias("focus"), F.col("p").alias("path"), "o.*"), "focus")
        if with_types:
            found = self.graph.match(Pattern("?node", RDF_TYPE, "?cls"), frozenset(["?cls"]), self.dataset)
            roles, typed = self._roles(table), found.select("node", "cls")
            # Without a closure there are a few roles per constraint; one class may hold most nodes, so they are not shuffled by it.
            met = typed.join(F.broadcast(roles), "cls") if self.closure is None else join_lookup(typed, roles, ["cls"])
            types = met.select("node", "id", "role")
        if grouped and single:  # both read the same rows
            values, types = (df if df is None else cut(df, "checked") for df in (values, types))
        parts = [self._grouped(table, values, types)] if grouped else []
        parts += [self._single(table, values, types)] if single else []
        return reduce(DataFrame.unionByName, parts).select(*COLUMNS)

    def _grouped(self, table: DataFrame, values: DataFrame | None, types: DataFrame | None) -> DataFrame:
        """Counts, domains and subclasses: values and types of a node meet in one aggregation, which combines on the map side."""
        rows = []
        if values is not None:
            rules = table.filter(F.col("kind").isin("min", "max", "domain")).select("id", "path")
            rows.append(values.select("focus", "path").join(rules, "path").select("focus", "id", F.lit(1).alias("has"), F.lit(0).alias("target"), F.lit(0).alias("member")))
        if types is not None:
            roles = self._focus_only(types.withColumnRenamed("node", "focus"), "focus")
            rows.append(roles.select("focus", "id", F.lit(0).alias("has"), (F.col("role") == "target").cast("int").alias("target"), (F.col("role") == "member").cast("int").alias("member")))
        groups = reduce(DataFrame.unionByName, rows).groupBy("focus", "id").agg(F.sum("has").alias("has"), F.max("target").alias("hit"), F.max("member").alias("member"))
        met = groups.join(table.select("id", "shape", "kind", "path", "n", F.col("target").alias("_target")), "id")
        aimed = F.when(F.col("_target") == "", F.col("has") > 0).otherwise(F.col("hit") == 1)
        wrong = (
            F.when(F.col("kind") == "min", aimed & (F.col("has") < F.col("n"))).when(F.col("kind") == "max", aimed & (F.col("has") > F.col("n")))
            .when(F.col("kind") == "domain", (F.col("has") > 0) & (F.col("member") == 0)).when(F.col("kind") == "subclass", (F.col("hit") == 1) & (F.col("member") == 0))
        )
        return met.filter(wrong).select("shape", "focus", "path", F.lit("").alias("value"), "kind")

    def _single(self, table: DataFrame, values: DataFrame, types: DataFrame | None) -> DataFrame:
        """What one value shows: its class, datatype, text, or that it is not in a list. A literal is an instance of no class."""
        rules = table.filter(F.col("kind").isin("class", "datatype", "in", "pattern")).select("id", "shape", "kind", "path", "arg", "allowed")
        met = values.join(rules, "path")
        term_ = F.struct("type", "value", F.coalesce("datatype", F.lit("")).alias("datatype"), F.coalesce("lang", F.lit("")).alias("lang"))
        same = F.lit(False)
        for wanted in sorted({s.arg for s in self._of("datatype")}):
            same = F.when(F.col("arg") == wanted, _is_of(wanted)).otherwise(same)
        wrong = (
            F.when(F.col("kind") == "datatype", ~F.coalesce(same, F.lit(False))).when(F.col("kind") == "in", ~F.array_contains("allowed", term_))
            .when(F.col("kind") == "pattern", ~F.regexp_like("value", F.col("arg")))
        )
        if self._of("class"):
            members = types.filter("role = 'member'").select(F.col("node").alias("_node"), F.col("id").alias("_id"), F.lit(1).alias("_member")).distinct()
            node = F.when((F.col("kind") == "class") & (F.col("type") != "literal"), F.col("value"))
            met = met.join(members, (node == F.col("_node")) & (F.col("id") == F.col("_id")), "left")
            wrong = wrong.when(F.col("kind") == "class", F.col("_member").isNull())
        return met.filter(wrong).select("shape", "focus", "path", "value", "kind")

    def is_valid(self) -> DataFrame:
        """One row, one boolean column ``valid``."""
        return self.violations().limit(1).agg((F.count("*") == 0).alias("valid"))


# The integer types of XML Schema with the least and greatest value, None where there is none.
INTEGER_RANGES = {
    "integer": (None, None), "nonNegativeInteger": (0, None), "positiveInteger": (1, None), "nonPositiveInteger": (None, 0), "negativeInteger": (None, -1),
    "long": (-2**63, 2**63 - 1), "int": (-2**31, 2**31 - 1), "short": (-2**15, 2**15 - 1), "byte": (-128, 127),
    "unsignedLong": (0, 2**64 - 1), "unsignedInt": (0, 2**32 - 1), "unsignedShort": (0, 2**16 - 1), "unsignedByte": (0, 255),
}


NUMBERS = {*INTEGER_RANGES, "decimal", "double", "float"}


def _is_of(wanted: str) -> Column:
    """Is a row's term a literal of a datatype, with text that is a value of it."""
    native = {XSD_BOOLEAN: "boolean", XSD_DATE: "date", XSD_DATETIME: "timestamp"}.get(wanted)
    same = (F.col("type") == "literal") & (F.col("datatype") == ("" if wanted.endswith("#string") else wanted))
    if wanted.rsplit("#")[-1] in NUMBERS:
        return same & _is_number(F.trim("value"), wanted.rsplit("#")[-1])
    return same & value_of(F.col("type"), F.col("value"), F.col("datatype"), native).isNotNull() if native else same


def _is_number(text: Column, name: str) -> Column:
    """Is the text a value of a numeric type; integers of any length are compared by sign, length and digits."""
    if name in ("double", "float"):
        return text.rlike(r"^([+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|[+-]?INF|NaN)$")
    if name not in INTEGER_RANGES:
        return text.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)$")
    digits = F.regexp_extract(text, r"^[+-]?0*(\d*)$", 1)
    below = text.startswith("-") & (digits != "")

    def at_least(bound: int) -> Column:
        size = str(abs(bound)) if bound else ""
        more = (F.length(digits) > len(size)) | ((F.length(digits) == len(size)) & (digits > size))
        less = (F.length(digits) < len(size)) | ((F.length(digits) == len(size)) & (digits < size))
        return (~below & ~less) if bound > 0 else ~below if bound == 0 else ~below | ~more

    low, high = INTEGER_RANGES[name]
    fits = text.rlike(r"^[+-]?\d+$")
    if low is not None:
        fits = fits & at_least(low)
    return fits & ~at_least(high + 1) if high is not None else fits


def limit_per_shape(violations: DataFrame, k: int, salts: int = SALTS) -> DataFrame:
    """The first ``k`` violations per shape by focus, path and value.

    There are few shapes and one may hold most violations, so each shape is first ranked within ``salts`` shares; at
    most ``k * salts`` rows per shape meet for the final ranking.
    """
    order = ["focus", "path", "value", "kind"]
    salted = violations.withColumn("_salt", F.pmod(F.xxhash64(*COLUMNS), F.lit(salts)))
    share = Window.partitionBy("shape", "_salt").orderBy(*order)
    whole = Window.partitionBy("shape").orderBy(*order)
    some = salted.withColumn("_n", F.row_number().over(share)).filter(F.col("_n") <= k)
    return some.withColumn("_n", F.row_number().over(whole)).filter(F.col("_n") <= k).select(*COLUMNS)


def report_violations(graph: Graph, constraints: list[Shape], closure: DataFrame | None = None, /, **options) -> DataFrame:
    """Violations under the options of a report; an unknown option is an error before any work starts."""
    for name in options:
        if name not in REPORT_OPTIONS:
            raise ValueError(f"Parameter not recognized: {name}")
    chosen = list(constraints)
    if options.get("shapes") is not None:
        chosen = [s for s in chosen if s.name in _as_list(options["shapes"])]
    if options.get("shacl.shape.graphs") is not None:
        chosen = [s for s in chosen if s.graph in _as_list(options["shacl.shape.graphs"])]
    dataset = EVERYTHING
    if options.get("graph-uri") is not None:
        dataset = Dataset.of(default=_as_list(options["graph-uri"]))
    if options.get("reasoning"):
        graph = ReasonedGraph(graph)
    # Only a given closure can make targets wider than stored types.
    follow = None if options.get("shacl.targetClass.simple") else closure
    nodes = options.get("nodes")
    if isinstance(nodes, str):
        nodes = [nodes]
    found = Validation(graph, chosen, follow, nodes, dataset).violations()
    if options.get("shacl.violation.limit.shape") is not None:
        found = limit_per_shape(found, int(options["shacl.violation.limit.shape"]))
    if options.get("countLimit") is not None:
        found = page(found, COLUMNS, limit=int(options["countLimit"]))
    return found


def report(graph: Graph, constraints: list[Shape], closure: DataFrame | None = None, /, **options) -> DataFrame:
    """One row: ``conforms`` and the number of violations found."""
    found = report_violations(graph, constraints, closure, **options)
    return found.agg((F.count("*") == 0).alias("conforms"), F.count("*").alias("violations"))


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)

