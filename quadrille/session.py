"""Session settings, lineage cuts and size checks shared by all operators."""

from __future__ import annotations

import atexit
import json
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast by hint only after its measured size is below this bound.
BROADCAST_BYTES = 16 * 1024 * 1024
SALTS = 64
#: Most bytes, as they lie in files or shuffles, that one task reads where they can be cut: rows of graphs take up to 30 times that in memory.
TASK_BYTES = 8 * 1024 * 1024
#: Shuffle partitions at least, before adaptive execution merges small ones. Up to so many Spark writes map output without holding it in memory.
PARTITIONS = 200
#: Rows with some text columns that one task may be made to hold, where they are dealt by a count.
TASK_ROWS = 500_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Split a skewed join side even where that costs one more exchange later in the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables of IRIs take several times the bytes of their files: without this the planner broadcasts what fills the driver.
    "spark.sql.sources.fileCompressionFactor": "10",
}
# Sizes that are lowered to so many bytes where they are larger; a cluster's own smaller ones stay.
AT_MOST = {
    "spark.sql.files.maxPartitionBytes": TASK_BYTES,
    # What a file counts beside its bytes: tasks that read small files get more than two of them.
    "spark.sql.files.openCostInBytes": TASK_BYTES // 128,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 4 * TASK_BYTES,
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings all plans rely on; the number of shuffle partitions and memory stay the cluster's own.

    What a task reads is bounded, however large the input is; adaptive execution merges partitions that are smaller.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in AT_MOST.items():
        if _size(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def _size(text: str) -> int:
    """A size of the settings in bytes: ``16m``, ``64MB``, ``1024``."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a folder of our own only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="quadrille-")
        atexit.register(shutil.rmtree, folder, True)
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh path below the shared folder, for tables a job writes and reads back. Within a :func:`scope` it belongs to that."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


# Scratch paths of the scopes that are open, innermost last.
_scopes: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end all scratch tables that were made within, also after an error.

    What was computed within must have been written elsewhere or collected by then: frames that still read the tables fail.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            remove(spark, path)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a statement within are deleted when it ends, and not when the driver next collects garbage.

    For writes: a write has a plan of its own, so nothing reads its shuffles again.
    """
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that was written as scratch; one that is not there is no error."""
    files, where = hadoop_path(spark, path)
    files.delete(where, True)


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path, as Hadoop objects."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def create_once(spark: SparkSession, path: str, record: dict) -> None:
    """Create a file with one line of JSON. It must not exist: of two writers only one succeeds, the other gets an error."""
    files, where = hadoop_path(spark, path)
    try:
        out = files.create(where, False)
    except Py4JJavaError as e:
        if files.exists(where):
            raise RuntimeError(f"{path} has been published by another writer") from e
        raise
    out.write(bytearray(json.dumps(record).encode() + b"\n"))
    out.close()


def dealt(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows in partitions of bounded size, by a hash of some columns, however many of them one task has read.

    A row group of a file is not cut, so an aggregation before the next shuffle would hold all its rows. The number they are dealt by is a
    column of its own: what comes next is shuffled by its own keys, and adaptive execution may split the partition of a row that is repeated often.
    """
    if not columns:
        return df
    number = max(df.columns, key=len) + "_"
    placed = df.withColumn(number, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(1 << 20)))
    return placed.hint("rebalance", F.col(f"`{number}`")).drop(number)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write as a table into the shared folder and read it back.

    Cuts the lineage, so plans of loops stay short and a lost executor costs no recomputation, and gives the planner
    real file sizes to choose joins by.
    """
    path = scratch(df.sparkSession, name)
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_measured(df: DataFrame, name: str = "cut", codec: str | None = None, **measures: Column) -> tuple[DataFrame, dict]:
    """As :func:`cut`, with aggregates of the written rows from the same pass: ``bytes``, and any others asked for.

    A task that runs twice may be counted twice, so sizes are upper bounds; they are exact about being zero. ``codec`` compresses
    the files in place of the session's own.
    """
    path, seen = scratch(df.sparkSession, name), Observation()
    size = F.coalesce(F.sum(_bytes(df.schema)), F.lit(0)).alias("bytes")
    with freed(df.sparkSession):
        df.observe(seen, size, *[c.alias(n) for n, c in measures.items()]).write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def _bytes(schema: T.StructType) -> Column:
    total = F.lit(0).cast("long")
    for field in schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(col)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = F.octet_length(F.to_json(F.struct(col)))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0)) + F.lit(16)
    return total


def measured_bytes(df: DataFrame) -> int:
    """Exact payload size by one partial-aggregated pass; one number reaches the driver."""
    return df.agg(F.coalesce(F.sum(_bytes(df.schema)), F.lit(0)).alias("b")).first()["b"]


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def join_lookup(big: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", limit: int | None = None,
                small: bool | None = None, folder: str | None = None) -> DataFrame:
    """Join a large, possibly skewed frame with a lookup table.

    The lookup is written once and measured while it is written. Up to the bound it is broadcast; beyond it the join is
    an ordinary shuffle join, whose hot partitions adaptive execution splits (``tune`` switches that on), so one key that
    holds a third of all rows is shared by many tasks and no key is repeated that need not be. ``small`` passes on a
    measurement made before, and the lookup is then used as it is. ``folder`` is a number among ``on`` by which the big side lies in folders: a
    condition on it, which all rows of the lookup meet, lets Spark read only the folders that the lookup names.
    """
    if small is None:
        lookup, seen = cut_measured(lookup, "lookup")
        small = seen["bytes"] <= (BROADCAST_BYTES if limit is None else limit)
    if folder is not None:
        lookup = lookup.filter(F.col(folder) >= 0)
    return big.join(F.broadcast(lookup) if small else lookup, on, how)
