"""Documents ``(name, content, length)`` with unique names: as tables, and as a store on disk.

Functions return plans, except that a list of names is measured when it is looked up.

Layout of a :class:`DocumentStore`::

    log-<n>-<id>/       what one call wrote: documents, and names without a document that are deleted, in hash buckets of the name
    versions/<n>.json   one line per published version: the logs that make it up, oldest first

Writing is appending: no old document is read or written again. Reading takes the last entry of a name: each log loses the names that a
later one has, of which only the names are read. Looking up names reads their buckets only.
"""

from __future__ import annotations

import binascii
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import create_once, hadoop_path, join_lookup

COLUMNS = ["name", "content", "length"]


def documents(df: DataFrame, name: str, content: str) -> DataFrame:
    """Any table as documents."""
    size = F.octet_length(F.col(content))
    return df.select(F.col(name).cast("string").alias("name"), F.col(content).cast("binary").alias("content"), size.cast("long").alias("length"))


def upsert(store: DataFrame, new: DataFrame) -> DataFrame:
    """Add documents, replacing those of the same name. Only the names of the new ones meet the old ones.

    Of several new texts of one name, that with the greatest ``order`` column stays if ``new`` has one, else the greatest
    content; one row per name always.
    """
    by = F.struct("order", "content") if "order" in new.columns else F.col("content")
    one = new.groupBy("name").agg(F.max_by(F.struct("content", "length"), by).alias("doc")).select("name", "doc.content", "doc.length")
    kept = store.join(one.select("name"), "name", "left_anti")
    return kept.select(*COLUMNS).unionByName(one.select(*COLUMNS))


def lookup(store: DataFrame, names: DataFrame) -> DataFrame:
    """Documents of many names at once; names without a document give no row."""
    return join_lookup(store, names.select("name").distinct(), ["name"], "left_semi").select(*COLUMNS)


def size(store: DataFrame) -> DataFrame:
    return store.agg(F.count("*").alias("n"))


def delete(store: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Without the named documents; without any when no names are given."""
    if names is None:
        return store.limit(0)
    return join_lookup(store, names.select("name").distinct(), ["name"], "left_anti").select(*COLUMNS)


BUCKETS, BUCKET = 64, "n_bucket"
_LOG = f"name string, content binary, length long, deleted boolean, {BUCKET} int"
_RECORD = "version long, logs array<string>"


def name_bucket(name):
    return F.pmod(F.crc32(name.cast("binary")), F.lit(BUCKETS)).cast("int")


class DocumentStore:
    """Documents below ``root``. Any session may open it; of two writers on one version one gets an error and may try again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _records(self) -> DataFrame:
        return self.spark.read.schema(_RECORD).json(f"{self.root}/versions")

    def _current(self) -> tuple[int, list[str]]:
        try:
            now = self._records().orderBy(F.desc("version")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            now = None
        return (now["version"], list(now["logs"])) if now else (0, [])

    def _publish(self, version: int, logs: list[str]) -> None:
        create_once(self.spark, f"{self.root}/versions/{version}.json", {"version": version, "logs": logs})

    def _append(self, rows: DataFrame) -> None:
        version, logs = self._current()
        self._publish(version + 1, [*logs, self._write(rows, version + 1)])

    def _write(self, rows: DataFrame, version: int) -> str:
        name = f"log-{version}-{uuid.uuid4().hex[:12]}"
        laid_out = rows.select("name", "content", "length", "deleted", name_bucket(F.col("name")).alias(BUCKET)).hint("rebalance", F.col(BUCKET))
        laid_out.write.partitionBy(BUCKET).parquet(f"{self.root}/{name}")
        return name

    def put(self, docs: DataFrame) -> None:
        """Add documents, in the place of those of the same name. Of several texts of one name the rules of :func:`upsert` choose."""
        one = upsert(docs.select(*COLUMNS).limit(0), docs.filter("name IS NOT NULL"))
        self._append(one.withColumn("deleted", F.lit(False)))

    def delete(self, names: DataFrame) -> None:
        """Delete the named documents; names without one are no error. Names alone are written."""
        gone = names.select("name").filter("name IS NOT NULL").distinct()
        self._append(gone.select("name", F.lit(None).cast("binary").alias("content"), F.lit(None).cast("long").alias("length"), F.lit(True).alias("deleted")))

    def clear(self) -> None:
        """Delete everything: a version without logs."""
        self._publish(self._current()[0] + 1, [])

    def _logs(self, logs: list[str], narrow=None) -> DataFrame:
        """The last entries of names; ``narrow`` cuts down each log before."""
        if not logs:
            return self.spark.createDataFrame([], _LOG)
        entries = [self.spark.read.schema(_LOG).parquet(f"{self.root}/{log}") for log in logs]
        entries = [narrow(e) for e in entries] if narrow else entries
        parts = [entries[-1]]
        for i in range(len(entries) - 2, -1, -1):
            later = reduce(DataFrame.unionByName, [e.select(BUCKET, "name") for e in entries[i + 1:]])
            parts.append(join_lookup(entries[i], later.distinct(), [BUCKET, "name"], "left_anti"))
        return reduce(DataFrame.unionByName, parts)

    def read(self) -> DataFrame:
        """All documents."""
        return self._logs(self._current()[1]).filter("NOT deleted").select(*COLUMNS)

    def get(self, names: DataFrame | list[str]) -> DataFrame:
        """The documents of some names; names without one give no row. Only the buckets of the names are read."""
        if isinstance(names, list):
            buckets = sorted({binascii.crc32(n.encode()) % BUCKETS for n in names})
            return self._logs(self._current()[1], lambda e: e.filter(F.col(BUCKET).isin(buckets) & F.col("name").isin(names))).filter("NOT deleted").select(*COLUMNS)
        keyed = names.select("name").distinct().withColumn(BUCKET, name_bucket(F.col("name")))
        return self._logs(self._current()[1], lambda e: join_lookup(e, keyed, [BUCKET, "name"], "left_semi", folder=BUCKET)).filter("NOT deleted").select(*COLUMNS)

    def size(self) -> DataFrame:
        """One row ``n``. Bodies are not read."""
        return self.read().agg(F.count(F.lit(1)).alias("n"))

    def compact(self, keep_first: bool = True) -> None:
        """Put the logs together: all but the first and largest one, or all of them. The documents stay the same."""
        version, logs = self._current()
        first = logs[:1] if keep_first else []
        if len(logs) - len(first) > 1:
            self._publish(version + 1, [*first, self._write(self._logs(logs[len(first):]), version + 1)])

    def clean(self) -> None:
        """Delete the files that the newest version does not name. Nobody may be reading older versions or be writing meanwhile."""
        version, logs = self._current()
        files, root = hadoop_path(self.spark, self.root)
        for found in files.listStatus(root):
            name = found.getPath().getName()
            if name.startswith("log-") and name not in logs:
                files.delete(found.getPath(), True)
        for found in files.listStatus(hadoop_path(self.spark, f"{self.root}/versions")[1]):
            if found.getPath().getName() != f"{version}.json":
                files.delete(found.getPath(), False)
