"""A graph set on disk and its updates.

Layout below a root folder::

    base-<n>-<id>/      all quads at one version, parquet in hash buckets of the predicate, sorted by predicate and subject
    delta-<n>-<id>/     op=added / op=removed: exactly the quads a commit changed, in the same buckets; op=again: quads of a graph that the
                        commit has emptied, which were there before
    fold-<n>-<id>/      some buckets of the base with deltas folded in, in the place of those buckets
    stars-<n>-<id>/     quads by subject, see stars.py; made and kept up by ``cluster`` and ``compact``
    sketch-<n>-<id>/    per predicate, what is known of a base or delta: quads, and sketches of its subjects and objects
    prefixes-<n>-<id>/  the prefix table
    versions/<n>.json   one line per published version: which base, which deltas, what they hold and which graphs they empty, which other tables

A commit writes one delta and then its version file, which is created only if it does not exist, so of two commits on one
version one fails; readers take the newest version file, so a job that dies in between changes nothing. Reading joins the
base with the quads that deltas have removed, and with nothing when they have only added. An emptied graph is a word in the version file and
a filter on what is older. ``compact`` folds the deltas into a new base, and ``clean`` deletes what no kept version names.

After every ``MOST_DELTAS`` commits ``upkeep`` runs by itself: buckets of which deltas hold more than ``FOLD_SHARE`` of the base are folded, one
folder for all of them and no other bucket rewritten, and the remaining deltas are merged into one.
"""

from __future__ import annotations

import binascii
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import DEFAULT_GRAPH, OBJECT, QUAD, QUAD_SCHEMA, as_set
from ..session import BROADCAST_BYTES, PARTITIONS, TASK_ROWS, create_once, cut, cut_measured, freed, hadoop_path, join_lookup, scope
from .graph import Graph, Pattern, StoredGraph
from .stars import EVERYTHING_CLEARED, Stars, write_stars

ADDED, REMOVED, AGAIN = "added", "removed", "again"
# Of a delta: quads added to and removed from what was there (those of emptied graphs too), removals it holds, graphs that were emptied and by which
# version, before what it adds, and the version that it made.
_DELTA = "struct<name string, added long, removed long, drops long, cleared array<struct<g string, seq long>>, seq long>"
# Of folded buckets: the newest version in them. Of stars: the version they show, and deltas that changed it since but are no longer read.
_RECORD = (
    f"version long, base string, deltas array<{_DELTA}>, prefixes string, folds array<struct<name string, upto long, buckets array<int>>>, "
    "stars struct<name string, parts int, upto long, pending array<string>>, sketches array<string>"
)
#: Subjects and values of stored quads are mostly distinct texts, which this codec halves and the usual one leaves as they are.
CODEC = "zstd"
#: Code of a stored quad beside those of operations, and staged quads for which a task of a large commit writes a file of its own.
STORED, FILE_ROWS = -1, 10_000
#: Cells that subjects are counted in before a large commit deals quads out by subject.
CELLS = 4096
#: Logarithm of the cells of a sketch: a standard error of about 1 %.
SKETCH = 14
#: Deltas after which upkeep runs, and the share of a bucket's base that its deltas may hold.
MOST_DELTAS, FOLD_SHARE = 16, 0.5
_PREFIXES = "prefix string, iri string"

# Folders of a base or delta: hash buckets of the predicate.
BUCKETS = 512
BUCKET = "p_bucket"


def anti(left: DataFrame, right: DataFrame) -> DataFrame:
    """Quads of ``left`` that are not in ``right``; buckets are compared too where both have them, so a filter on one reaches both."""
    keys = [*QUAD, BUCKET] if BUCKET in left.columns and BUCKET in right.columns else QUAD
    return left.join(right.select(*keys), keys, "left_anti")


def last_operation(log: DataFrame) -> DataFrame:
    """The last ``op`` per quad of a log with ``_seq``, as one number per quad, so that a hash aggregation can do it."""
    code = F.col("_seq") * 2 + F.when(F.col("op") == REMOVED, 0).otherwise(1)
    keys = [*QUAD, BUCKET] if BUCKET in log.columns else QUAD
    last = log.groupBy(*keys).agg(F.max(code).alias("_code"))
    return last.select(*keys, F.when(F.col("_code") % 2 == 1, ADDED).otherwise(REMOVED).alias("op"))


def predicate_bucket(p):
    return F.pmod(F.crc32(p), F.lit(BUCKETS)).cast("int")


def with_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn(BUCKET, predicate_bucket(F.col("p")))


def write_quads(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write quads in buckets of the predicate.

    ``rebalance`` lets adaptive execution cut the rows of a hot bucket into files of even size and merge the rows of rare
    ones. Files are sorted by predicate and subject, which gives row groups useful bounds.
    """
    laid_out = with_bucket(df.select(*QUAD)).hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, "p", "s")
    with freed(df.sparkSession):
        laid_out.write.mode(mode).partitionBy(BUCKET).parquet(path, compression=CODEC)


def fingerprint() -> Column:
    """128 bits of a quad: of a SHA-256 over the lengths of its texts, then the texts, so that no two quads have the same input."""
    lengths = [F.coalesce(F.octet_length(c), F.lit(-1)).cast("string") for c in QUAD]
    return F.substring(F.unhex(F.sha2(F.concat_ws("\n", *lengths, *QUAD), 256)), 1, 16)


_STORED = "s string, p string, o_value string, o_type string, o_datatype string, o_lang string, g string"


def read_quads(spark: SparkSession, path: str) -> DataFrame:
    """Quads written by :func:`write_quads`, with their bucket; a constant predicate reads its own folder only."""
    return spark.read.schema(f"{_STORED}, {BUCKET} int").parquet(path).select(*QUAD, BUCKET)


def drops(delta: dict) -> int:
    """Removals in the files of a delta; a record of an earlier layout has only those."""
    return delta["removed"] if delta.get("drops") is None else delta["drops"]


def cleared_by(deltas: list[dict], after: int = -1) -> frozenset[str]:
    """Graphs that some deltas empty, by a version ``after`` another."""
    return frozenset(c["g"] for d in deltas for c in d.get("cleared") or () if c["seq"] > after)


def uncleared(quads: DataFrame, cleared: frozenset[str]) -> DataFrame:
    """Quads without those of emptied graphs."""
    if EVERYTHING_CLEARED in cleared:
        return quads.filter(F.lit(False))
    return quads.filter(~F.col("g").isin(sorted(cleared))) if cleared else quads


class BucketedGraph(StoredGraph):
    """Stored quads in hash buckets: adds the bucket of a constant predicate to the filter. ``stars`` answers patterns on one subject."""

    def __init__(self, raw: DataFrame, stars: Stars | None = None):
        super().__init__(raw.select(*QUAD))
        self._raw, self._stars = raw, stars

    def match_star(self, patterns, nodes, dataset):
        found = None if self._stars is None else self._stars.match(self, list(patterns), nodes, dataset)
        return None if found is None else (found, {})

    def statements(self, predicates, dataset=None):
        from .graph import EVERYTHING

        buckets = sorted({binascii.crc32(p.encode()) % BUCKETS for p in predicates})
        return StoredGraph(self._raw.filter(F.col(BUCKET).isin(buckets)).select(*QUAD)).statements(predicates, dataset or EVERYTHING)

    def match_any(self, pattern, names, dataset=None):
        # With the bucket among the keys, only the folders of the names are read, which is found out while the query runs.
        from .graph import EVERYTHING

        keyed = names.select("p", predicate_bucket(F.col("p")).alias(BUCKET)).distinct()
        met = StoredGraph(join_lookup(self._raw, keyed, ["p", BUCKET], "left_semi", folder=BUCKET))
        plain = Pattern(pattern.s, "?_p", pattern.object_var or pattern.o, pattern.graph)
        return as_set(met.match(plain, frozenset(), dataset or EVERYTHING).drop("_p"))

    def match(self, pattern, nodes=frozenset(), dataset=None):
        from ..model import is_var
        from .graph import EVERYTHING

        dataset = dataset or EVERYTHING
        if is_var(pattern.p):
            return super().match(pattern, nodes, dataset)
        # The bucket as a plain number: it prunes folders and passes through the join of base and deltas.
        bucket = binascii.crc32(pattern.p.encode()) % BUCKETS
        return StoredGraph(self._raw.filter(F.col(BUCKET) == bucket).select(*QUAD)).match(pattern, nodes, dataset)


def stored_graph(spark: SparkSession, path: str) -> StoredGraph:
    return BucketedGraph(read_quads(spark, path))


class GraphStore:
    """Versioned graph set below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, root: str, quads: DataFrame | None = None, is_set: bool = False) -> GraphStore:
        """A new store; an existing one is an error. ``is_set`` skips the duplicate check of ``quads``."""
        store = cls(spark, root)
        quads = spark.createDataFrame([], QUAD_SCHEMA) if quads is None else quads
        if store._exists():
            raise ValueError(f"{root} holds a graph set already")
        store._rebase(1, quads if is_set else as_set(quads))
        return store

    def _exists(self) -> bool:
        try:
            self._record()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def _fresh(self, kind: str, version: int) -> str:
        """A folder name no other or failed commit uses."""
        return f"{kind}-{version}-{uuid.uuid4().hex[:12]}"

    def _publish(self, record: dict) -> None:
        create_once(self.spark, f"{self.root}/versions/{record['version']}.json", record)

    def _rebase(self, version: int, quads: DataFrame, prefixes: str = "", stars: bool = False, sketches: bool = False) -> None:
        name = self._fresh("base", version)
        write_quads(quads, f"{self.root}/{name}")
        made = self._write_stars(version, self._base(name)) if stars else None
        counted = [self._write_sketch(version, self._base(name))] if sketches else []
        self._publish({"version": version, "base": name, "deltas": [], "prefixes": prefixes, "folds": [], "stars": made, "sketches": counted})

    def _write_stars(self, version: int, quads: DataFrame) -> dict:
        name = self._fresh("stars", version)
        return {"name": name, "parts": write_stars(quads, f"{self.root}/{name}"), "upto": version, "pending": []}

    def cluster(self) -> None:
        """Publish a version that also holds the quads by subject, so that patterns on one subject are one scan. Commits keep it usable: subjects
        they touch are asked of the predicate buckets. ``compact`` writes it anew."""
        record = self._record()
        version = record["version"] + 1
        self._publish(record | {"version": version, "stars": self._write_stars(version, self._read(record).select(*QUAD))})

    def _stars(self, record: dict) -> Stars | None:
        kept = record.get("stars")
        if not kept:
            return None
        later = [d for d in record["deltas"] if (d["seq"] or 0) > kept["upto"]]
        names = [*(kept["pending"] or ()), *(d["name"] for d in later)]
        changes = [self.spark.read.schema("s string, g string").parquet(f"{self.root}/{name}").select("s", "g") for name in names]
        return Stars(self.spark, f"{self.root}/{kept['name']}", kept["parts"], reduce(DataFrame.unionByName, changes) if changes else None,
                     cleared_by(record["deltas"], kept["upto"]))

    def _records(self) -> DataFrame:
        return self.spark.read.schema(_RECORD).json(f"{self.root}/versions")

    def _record(self) -> dict:
        return self._records().orderBy(F.desc("version")).first().asDict(recursive=True)

    def current(self) -> tuple[int, str, list[dict]]:
        """Version, base, and deltas with their names and how many quads they have added and removed."""
        record = self._record()
        return record["version"], record["base"], record["deltas"]

    def _delta(self, deltas: list[dict]) -> DataFrame:
        """All operations of some deltas that no later one of them has undone by emptying a graph: quads, bucket, ``op`` and ``_seq``."""
        schema = f"{_STORED}, op string, {BUCKET} int"
        parts = [uncleared(self.spark.read.schema(schema).parquet(f"{self.root}/{d['name']}"), cleared_by(deltas[i + 1:])).withColumn("_seq", F.lit(d["seq"] or 0))
                 for i, d in enumerate(deltas)]
        return reduce(DataFrame.unionByName, parts)

    def quads(self) -> DataFrame:
        return self._read(self._record()).select(*QUAD)

    def _stored(self, record: dict) -> DataFrame:
        """Base and folded buckets, without the graphs that deltas not yet in them have emptied."""
        folds = record.get("folds") or []
        covered = sorted(b for f in folds for b in f["buckets"])
        base = self._base(record["base"])
        parts = [uncleared(base.filter(~F.col(BUCKET).isin(covered)) if covered else base, cleared_by(record["deltas"]))]
        for f in folds:
            parts.append(uncleared(self._base(f["name"]).filter(F.col(BUCKET).isin(f["buckets"])), cleared_by(record["deltas"], f["upto"])))
        return reduce(DataFrame.unionByName, parts)

    def _live(self, record: dict, deltas: list[dict] | None = None) -> DataFrame:
        """All operations of the deltas that are in no folded bucket: quads, bucket, ``op`` and ``_seq``."""
        every = self._delta(record["deltas"] if deltas is None else deltas)
        for f in record.get("folds") or []:
            every = every.filter(~(F.col(BUCKET).isin(f["buckets"]) & (F.col("_seq") <= f["upto"])))
        return every

    def _read(self, record: dict) -> DataFrame:
        """The quads with their buckets.

        A delta holds real changes only. So the base loses what was ever removed, and what is added last comes from the deltas. Of a graph
        that a delta empties, only what this and later deltas add is left.
        """
        stored, deltas = self._stored(record), record["deltas"]
        if not deltas:
            return stored
        every = self._live(record)
        removed = every.filter(F.col("op") == REMOVED)
        kept = anti(stored, removed) if any(drops(d) for d in deltas) else stored
        added = every.drop("_seq") if len(deltas) == 1 else last_operation(every) if any(drops(d) for d in deltas) else every
        return kept.unionByName(added.filter(F.col("op") != REMOVED).select(*QUAD, BUCKET))

    def _base(self, base: str) -> DataFrame:
        return read_quads(self.spark, f"{self.root}/{base}")

    def graph(self) -> StoredGraph:
        record = self._record()
        return BucketedGraph(self._read(record), self._stars(record))

    def changes_since(self, old: dict) -> tuple[DataFrame, DataFrame] | None:
        """Quads added and removed since an earlier record, from deltas alone. None where these do not tell: after a compaction or upkeep, and
        where a graph was emptied."""
        record = self._record()
        names = [d["name"] for d in old["deltas"]]
        new = record["deltas"][len(names):]
        if record["base"] != old["base"] or (record["folds"] or []) != (old["folds"] or []) or [d["name"] for d in record["deltas"][:len(names)]] != names or cleared_by(new):
            return None
        if not new:
            nothing = self.spark.createDataFrame([], QUAD_SCHEMA)
            return nothing, nothing
        # A delta holds real changes, so the first one of a quad says whether it was there, and the last one whether it is.
        ops = self._delta(new).groupBy(*QUAD).agg(F.min_by("op", "_seq").alias("first"), F.max_by("op", "_seq").alias("last"))
        return ops.filter((F.col("first") == ADDED) & (F.col("last") == ADDED)).select(*QUAD), ops.filter((F.col("first") == REMOVED) & (F.col("last") == REMOVED)).select(*QUAD)

    def prefixes(self) -> DataFrame:
        """The prefix table ``(prefix, iri)`` of the store."""
        name = self._record()["prefixes"]
        if not name:
            return self.spark.createDataFrame([], _PREFIXES)
        return self.spark.read.schema(_PREFIXES).parquet(f"{self.root}/{name}")

    def set_prefixes(self, table: DataFrame) -> None:
        """Publish a version with another prefix table; prefixes must be unique."""
        record = self._record()
        if not table.groupBy("prefix").count().where("count > 1").isEmpty():
            raise ValueError("a prefix is declared twice")
        version = record["version"] + 1
        name = self._fresh("prefixes", version)
        table.select("prefix", "iri").write.parquet(f"{self.root}/{name}")
        self._publish(record | {"version": version, "prefixes": name})

    def clean(self, keep: int = 1) -> None:
        """Delete the files of all but the newest ``keep`` versions, and what failed commits have left.

        Nobody may be reading older versions or be committing meanwhile.
        """
        kept = self._records().orderBy(F.desc("version")).limit(keep).collect()
        names = {"versions", *(r["base"] for r in kept), *(r["prefixes"] for r in kept), *(d["name"] for r in kept for d in r["deltas"])}
        names |= {x for r in kept if r["stars"] for x in (r["stars"]["name"], *(r["stars"]["pending"] or ()))}
        names |= {x for r in kept for x in (r["sketches"] or ())} | {f["name"] for r in kept for f in r["folds"] or ()}
        files, root = hadoop_path(self.spark, self.root)
        for found in files.listStatus(root):
            name = found.getPath().getName()
            if name not in names and name.split("-")[0] in ("base", "delta", "prefixes", "stars", "fold", "sketch"):
                files.delete(found.getPath(), True)
        versions = {f"{r['version']}.json" for r in kept}
        for found in files.listStatus(hadoop_path(self.spark, f"{self.root}/versions")[1]):
            if found.getPath().getName() not in versions:
                files.delete(found.getPath(), False)

    def begin(self, reasoning: bool = False) -> Batch:
        return Batch(self, reasoning)

    def size(self) -> DataFrame:
        """Exact number of quads, one row ``n``: one pass over the merged state."""
        return self.quads().agg(F.count("*").alias("n"))

    def size_estimate(self) -> DataFrame:
        """Number of quads, one row ``n``, from row counts in file footers and version records: base + added - removed, no join."""
        record = self._record()
        changed = sum(d["added"] - d["removed"] for d in record["deltas"])
        return self._base(record["base"]).agg((F.count("*") + F.lit(changed)).alias("n"))

    def _write_sketch(self, version: int, quads: DataFrame) -> str:
        name = self._fresh("sketch", version)
        term = F.concat_ws("\n", *OBJECT)
        sketches = quads.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("s", F.lit(SKETCH)).alias("subjects"), F.hll_sketch_agg(term, F.lit(SKETCH)).alias("objects"))
        sketches.write.parquet(f"{self.root}/{name}")
        return name

    def analyze(self) -> None:
        """Publish a version with sketches of every predicate. Commits and ``compact`` keep them up: a commit counts only what it adds."""
        record = self._record()
        version = record["version"] + 1
        self._publish(record | {"version": version, "sketches": [self._write_sketch(version, self._read(record))]})

    def estimates(self) -> DataFrame:
        """``(p, quads, subjects, objects)``: about how many quads and different subjects and objects a predicate has, from sketches that were added
        up; no quad is read. A sketch cannot forget: what has been removed since the last ``analyze`` or ``compact`` still counts."""
        names = self._record()["sketches"]
        if not names:
            raise ValueError("the store has not been analyzed")
        parts = [self.spark.read.schema("p string, n long, subjects binary, objects binary").parquet(f"{self.root}/{name}") for name in names]
        merged = reduce(DataFrame.unionByName, parts).groupBy("p").agg(F.sum("n").alias("quads"), *[F.hll_union_agg(c).alias(c) for c in ("subjects", "objects")])
        return merged.select("p", "quads", *[F.hll_sketch_estimate(c).alias(c) for c in ("subjects", "objects")])

    def compact(self) -> None:
        """Fold the deltas into a new base with fresh, sorted files; the content stays the same."""
        record = self._record()
        self._rebase(record["version"] + 1, self._read(record), record["prefixes"], bool(record["stars"]), bool(record["sketches"]))

    def upkeep(self, share: float = FOLD_SHARE) -> list[int]:
        """Keep reads fast at a cost that follows the changes; the content stays the same. Returns the buckets that were folded.

        Buckets of which the deltas hold more than ``share`` of what is stored are written anew, the others stay as they are. Deltas that are in
        no other bucket are then no longer read, and the rest of them become one.
        """
        record = self._record()
        deltas, version = record["deltas"], record["version"] + 1
        if not deltas:
            return []
        # Rows per bucket, at most BUCKETS of them, from footers.
        held = {r[BUCKET]: r["count"] for r in self._stored(record | {"deltas": []}).groupBy(BUCKET).count().collect()}
        changed = {r[BUCKET]: r["count"] for r in self._live(record).groupBy(BUCKET).count().collect()}
        chosen = sorted(b for b, n in changed.items() if n > share * held.get(b, 0))
        newest = deltas[-1]["seq"] or 0
        folds = [f | {"buckets": [b for b in f["buckets"] if b not in chosen]} for f in record.get("folds") or []]
        folds = [f for f in folds if f["buckets"]]
        if chosen:
            name = self._fresh("fold", version)
            write_quads(self._read(record).filter(F.col(BUCKET).isin(chosen)).select(*QUAD), f"{self.root}/{name}")
            folds.append({"name": name, "upto": newest, "buckets": chosen})
        after = record | {"version": version, "folds": folds}
        rest = cut(self._live(after), "rest")
        # Of each quad, whether any of it was removed, and how it ended.
        ends = last_operation(rest).filter(F.col("op") != REMOVED)
        gone = rest.filter(F.col("op") == REMOVED).select(*QUAD, BUCKET).distinct()
        name = self._fresh("delta", version)
        one = ends.select(*QUAD, BUCKET, "op").unionByName(gone.withColumn("op", F.lit(REMOVED)))
        with freed(self.spark):
            one.hint("rebalance", F.col("op"), F.col(BUCKET)).write.partitionBy("op", BUCKET).parquet(f"{self.root}/{name}", compression=CODEC)
        dropped = sum(r["count"] for r in self.spark.read.schema("s string, op string").parquet(f"{self.root}/{name}").groupBy("op").count().collect() if r["op"] == REMOVED)
        total = {k: sum(d[k] for d in deltas) for k in (ADDED, REMOVED)}
        merged = {"name": name, **total, "drops": dropped, "cleared": [c for d in deltas for c in d["cleared"] or ()], "seq": newest}
        stars = record["stars"]
        if stars:
            stars = stars | {"pending": [*(stars["pending"] or ()), *(d["name"] for d in deltas if (d["seq"] or 0) > stars["upto"])]}
        self._publish(after | {"deltas": [merged], "stars": stars})
        return chosen

    def snapshot(self, to: str) -> None:
        """A full copy at ``to``, quads and prefixes; an existing target is an error."""
        write_quads(self.quads(), f"{to}/quads")
        self.prefixes().write.parquet(f"{to}/prefixes")


def restore(spark: SparkSession, from_path: str, root: str, force: bool = False) -> GraphStore:
    """A store at ``root`` from a snapshot. An existing store is an error unless ``force``, which publishes the
    snapshot as its next version."""
    store = GraphStore(spark, root)
    version = store.current()[0] if store._exists() else 0
    if version and not force:
        raise ValueError(f"{root} holds a graph set already")
    name = store._fresh("prefixes", version + 1)
    spark.read.schema(_PREFIXES).parquet(f"{from_path}/prefixes").write.parquet(f"{store.root}/{name}")
    store._rebase(version + 1, read_quads(spark, f"{from_path}/quads"), name)
    return store


class Batch:
    """Staged changes. Nothing is written before ``commit``; reads through the batch see its own changes.

    With ``reasoning`` all reads of the batch are reasoned; without, a single read cannot turn it on.
    """

    def __init__(self, store: GraphStore, reasoning: bool = False):
        self.store, self.reasoning, self.open = store, reasoning, True
        self._record = store._record()
        self._version, self._deltas = self._record["version"], self._record["deltas"]
        self._log: list[tuple[str, DataFrame]] = []
        self._cleared: frozenset[str] = frozenset()

    def _check(self) -> None:
        if not self.open:
            raise RuntimeError("the batch is closed")

    def _net(self) -> DataFrame:
        """Last operation per quad in the batch."""
        parts = [df.select(*QUAD, F.lit(i).alias("_seq"), F.lit(op).alias("op")) for i, (op, df) in enumerate(self._log)]
        every = reduce(DataFrame.unionByName, parts)
        return last_operation(every)

    def _before(self) -> DataFrame:
        return self.store._read(self._record)

    def quads(self) -> DataFrame:
        """The staged state."""
        self._check()
        before = uncleared(self._before(), self._cleared).select(*QUAD)
        if not self._log:
            return before
        net = self._net()
        return anti(before, net).unionByName(net.filter(F.col("op") == ADDED).select(*QUAD))

    def graph(self, reasoning: bool = False) -> Graph:
        """The staged state for matching; the flag of the batch decides about reasoning."""
        from .reasoning import ReasonedGraph

        staged = StoredGraph(self.quads())
        return ReasonedGraph(staged) if self.reasoning else staged

    def add(self, quads: DataFrame, graph: str | None = None) -> Batch:
        """INSERT DATA: add quads, all to ``graph`` when given."""
        self._check()
        self._log.append((ADDED, quads if graph is None else quads.withColumn("g", F.lit(graph))))
        return self

    def remove(self, quads: DataFrame, graph: str | None = None) -> Batch:
        """DELETE DATA: remove quads, from ``graph`` alone when given."""
        self._check()
        self._log.append((REMOVED, quads if graph is None else quads.withColumn("g", F.lit(graph))))
        return self

    def clear(self, graph: str | None = None) -> Batch:
        """Empty one graph, or everything when none is named: nothing is read or written for it, and what was staged for it is forgotten."""
        self._check()
        if graph is None:
            self._log, self._cleared = [], frozenset([EVERYTHING_CLEARED])
        else:
            self._log = [(op, df.filter(F.col("g") != graph)) for op, df in self._log]
            self._cleared |= {graph}
        return self

    def insert_where(self, solutions: DataFrame, template, graph: str = DEFAULT_GRAPH) -> Batch:
        """Add the triples a template makes of solutions, usually of ``bgp(batch.graph(), ...)``."""
        from .patterns import construct

        return self.add(construct(solutions, template, graph))

    def delete_where(self, solutions: DataFrame, template, graph: str = DEFAULT_GRAPH) -> Batch:
        from .patterns import construct

        return self.remove(construct(solutions, template, graph))

    def rollback(self) -> None:
        self._check()
        self.open = False

    def _emptied(self) -> Column:
        """Is a quad of a graph that the batch empties."""
        return F.lit(True) if EVERYTHING_CLEARED in self._cleared else F.col("g").isin(sorted(self._cleared)) if self._cleared else F.lit(False)

    def _met(self, staged: DataFrame, rows: int, before: DataFrame, touched: list[int]) -> tuple[DataFrame, bool]:
        """The last operation ``op`` of each staged quad, and whether it is ``_there`` before: one shuffle of what is staged and stored.
        And whether its tasks hold ``FILE_ROWS`` staged quads a bucket, so that each can write files of its own.

        Quads are dealt out by their subjects, so the staged quads of one subject, which mostly come one after the other, lie side by side in the
        shuffle and their subject is compressed away. Of a stored quad only its fingerprint is moved. Subjects are counted in cells first: where
        a cell is far larger than others, it holds a subject with very many quads, and the quads of that cell are dealt out one by one.
        """
        cell = F.pmod(F.xxhash64("s"), F.lit(CELLS))
        held = staged.select("s").unionByName(self.store._stored(self._record).filter(F.col(BUCKET).isin(touched)).select("s"))
        if self._deltas:
            held = held.unionByName(self.store._live(self._record).filter(F.col(BUCKET).isin(touched)).select("s"))
        counts = {r["_cell"]: r["count"] for r in held.groupBy(cell.alias("_cell")).count().collect()}  # CELLS at most
        total = sum(counts.values())
        large = sorted(c for c, n in counts.items() if n > max(TASK_ROWS, 4 * total // CELLS))
        of_subject = F.xxhash64("s", F.lit(1))
        number = F.pmod(F.when(cell.isin(large), F.xxhash64(*QUAD)).otherwise(of_subject) if large else of_subject, F.lit(1 << 20)).cast("int")
        code = F.col("_seq") * 2 + F.when(F.col("op") == REMOVED, 0).otherwise(1)
        new = staged.select(number.alias("_number"), code.alias("_code"), F.lit(None).cast("binary").alias("_print"), *QUAD)
        old = before.select(number.alias("_number"), F.lit(STORED).alias("_code"), fingerprint().alias("_print"))
        partitions = max(PARTITIONS, int(self.store.spark.conf.get("spark.sql.shuffle.partitions")), total // (4 * TASK_ROWS))
        every = new.unionByName(old, allowMissingColumns=True).repartition(partitions, "_number")
        every = every.withColumn("_print", F.coalesce("_print", fingerprint()))
        quad = F.first(F.when(F.col("_code") != STORED, F.struct(*QUAD)), ignorenulls=True)
        last = every.groupBy("_number", "_print").agg(F.max("_code").alias("_code"), F.min("_code").alias("_least"), quad.alias("_quad"))
        known = with_bucket(last.filter(F.col("_code") != STORED).select("_quad.*", "_code", (F.col("_least") == STORED).alias("_there")))
        return known.withColumn("op", F.when(F.col("_code") % 2 == 1, ADDED).otherwise(REMOVED)), rows >= FILE_ROWS * partitions * len(touched)

    def changes(self) -> DataFrame:
        """Quads the batch really changes, with ``op``: added ones not there before, removed ones that were. Quads of an emptied graph
        that were there and are there again have the op ``again``; others of such a graph are not listed.

        What is staged is written and measured. Of a small batch the stored side is first reduced to the quads it touches, by a join whose small
        side is the batch; they are then known by number. A large one meets the stored side in one aggregation, see :meth:`_met`.
        """
        return self._changes()[0]

    def _changes(self) -> tuple[DataFrame, bool]:
        """The changes, and whether tasks may write them as they have them."""
        self._check()
        keys = [*QUAD, BUCKET]
        parts = [df.select(*QUAD, F.lit(i).alias("_seq"), F.lit(op).alias("op")) for i, (op, df) in enumerate(self._log)]
        staged, seen = cut_measured(with_bucket(reduce(DataFrame.unionByName, parts)), "staged", CODEC, rows=F.count(F.lit(1)))
        # The buckets the batch touches, of at most BUCKETS; all other folders of the base stay unread.
        touched = [r[BUCKET] for r in staged.select(BUCKET).distinct().collect()]
        before, own = self._before().filter(F.col(BUCKET).isin(touched)), False
        if seen["bytes"] <= BROADCAST_BYTES:
            net = cut(last_operation(staged).withColumn("_id", F.monotonically_increasing_id()))
            there = before.join(net.select(*keys, "_id"), keys).select("_id", F.lit(True).alias("_there"))
            known = net.join(there, "_id", "left").withColumn("_there", F.coalesce("_there", F.lit(False)))
        else:
            known, own = self._met(staged, seen["rows"], before, touched)
        emptied = known.filter(self._emptied() & (F.col("op") == ADDED)).withColumn("op", F.when(F.col("_there"), AGAIN).otherwise(ADDED))
        others = known.filter(~self._emptied() & ((F.col("op") == REMOVED) == F.col("_there")))
        return (others.unionByName(emptied) if self._cleared else others).select(*keys, "op"), own and not self._cleared

    def commit(self) -> dict[str, int]:
        """Publish as the next version and return how many quads were added and removed.

        Fails when another commit was published since the batch began.
        """
        self._check()
        version = self._version + 1
        counts = {ADDED: 0, REMOVED: 0}
        if self._log or self._cleared:
            name = self.store._fresh("delta", version)
            path = f"{self.store.root}/{name}"
            spark, done = self.store.spark, {}
            if self._log:
                with scope(spark), freed(spark):  # what was staged is needed no longer
                    found, own = self._changes()
                    laid_out = found if own else found.hint("rebalance", F.col("op"), F.col(BUCKET))
                    laid_out.write.partitionBy("op", BUCKET).parquet(path, compression=CODEC)
                rows = spark.read.schema("s string, op string").parquet(path).groupBy("op").count().collect()
                done = {r["op"]: r["count"] for r in rows}
            else:
                spark.createDataFrame([], f"{_STORED}, op string, {BUCKET} int").write.parquet(path)
            gone = self._before().filter(self._emptied()).count() if self._cleared else 0
            counts = {ADDED: done.get(ADDED, 0), REMOVED: done.get(REMOVED, 0) + gone - done.get(AGAIN, 0)}
            deltas = [*self._deltas, {"name": name, **counts, "drops": done.get(REMOVED, 0), "cleared": [{"g": g, "seq": version} for g in sorted(self._cleared)], "seq": version}]
            sketches = self._record["sketches"] or []
            if sketches and done.get(ADDED, 0):
                new = spark.read.schema(f"{_STORED}, op string").parquet(path).filter(F.col("op") == ADDED)
                sketches = [*sketches, self.store._write_sketch(version, new)]
            self.store._publish(self._record | {"version": version, "deltas": deltas, "sketches": sketches})
            if len(deltas) >= MOST_DELTAS:
                self.store.upkeep()
        self.open = False
        return counts
