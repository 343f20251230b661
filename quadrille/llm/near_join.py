"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with the same set of word shingles form a class; only one document of a class, its representative, is compared.
Representatives meet in the buckets of a banded MinHash index. Within a bucket, MinHash values of a pair are compared step
by step; after each step, a pair whose posterior probability of reaching the threshold has fallen below the tolerance is
dropped. What is left is verified exactly on the whole shingle sets.

A large bucket is cut into blocks of members, and each pair of blocks is a task of its own, so no task holds more than two blocks
and no list of pairs ever leaves a task. A bucket has few blocks, which grow with it up to a bound in members and in bytes, so that a
member is sent to few tasks; within a task the blocks are compared tile by tile. The first pass returns the members that still have a partner, the second sends
their shingle sets to the same pairs of blocks, and returns for each member the documents it is linked to as a number, and one
edge towards the smallest member it hangs together with. A pair is compared only in the first bucket it shares.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .common import Rolling, column, id_and_bytes, mixed, texts, with_results, word_hashes
from .components import components

WORDS, THRESHOLD = 5, 0.8
#: Bands of MinHash values: a pair at 0.8 shares one with a chance of 1 - (1 - 0.8^3)^24, all but 3 in 10^8.
BANDS, ROWS = 24, 3
#: MinHash values compared at a time, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 24, 1e-7
#: Members of a block. It has ``TILE`` until a bucket has ``BLOCKS`` of them; from then on blocks grow, up to ``BLOCK`` members. Shingle sets of
#: a block have about ``BLOCK_BYTES``, however long its texts are.
TILE, BLOCKS, BLOCK, BLOCK_BYTES = 256, 32, 4096, 16 << 20
HASHES = BANDS * ROWS
_CHUNK = 4096


@lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    return mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(words: list[bytes], n: int = WORDS, rolling: Rolling | None = None) -> np.ndarray:
    """Sorted distinct hashes of runs of ``n`` words; a shorter text is one run, no word gives none."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    if len(hashes) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    return np.unique(mixed((rolling or Rolling(n, 0xC2B2AE3D27D4EB4F))(hashes)))


def signature(grams: np.ndarray) -> np.ndarray:
    """``HASHES`` MinHash values of 32 bits."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(grams), _CHUNK):
        np.minimum(low, (grams[None, i:i + _CHUNK] * _multipliers()[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, for a matrix of signatures."""
    parts = values.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        key = mixed((key * np.uint64(0x9E3779B97F4A7C15)) ^ parts[:, :, r])
    return key.view(np.int64)


@lru_cache(maxsize=64)
def least_matches(compared: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values out of ``compared`` that leave a pair a chance, with all similarities equally likely before."""
    x = (np.arange(20_000) + 0.5) / 20_000
    for found in range(compared + 1):
        log = found * np.log(x) + (compared - found) * np.log1p(-x)
        chance = np.exp(log - log.max())
        if chance[x >= threshold].sum() / chance.sum() >= tolerance:
            return found
    return compared


def likely_pairs(left: np.ndarray, right: np.ndarray, start: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Of the pairs marked in the matrix ``start``, those (rows of indexes) that no step has dropped."""
    pairs = np.argwhere(start)
    found = np.zeros(len(pairs), np.int64)
    for upto in range(STEP, HASHES + 1, STEP):
        a, b = pairs[:, 0], pairs[:, 1]
        found += (left[a, upto - STEP:upto] == right[b, upto - STEP:upto]).sum(axis=1)
        stay = found >= least_matches(upto, threshold, tolerance)
        pairs, found = pairs[stay], found[stay]
    return pairs


def block_count(members, grams):
    """Blocks of a bucket, from the columns of its members and of the shingles of all of them."""
    few = F.least(F.ceil(members / TILE), F.lit(BLOCKS).cast("long"))
    return F.greatest(few, F.ceil(members / BLOCK), F.least(F.ceil(grams * 8 / BLOCK_BYTES), members))


def _candidates(table, values: np.ndarray, threshold: float, tolerance: float) -> Iterator[np.ndarray]:
    """Pairs of places in a task that meet here first and that no step has dropped, a tile of both blocks at a time."""
    band, i, j = (table.column(c)[0].as_py() for c in ("band", "i", "j"))
    keys, sides = band_keys(values)[:, :band], table.column("side").to_numpy()
    one = i == j
    left, right = (np.arange(len(sides)),) * 2 if one else (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1))
    for a in range(0, len(left), TILE):
        for b in range(a if one else 0, len(right), TILE):
            x, y = left[a:a + TILE], right[b:b + TILE]
            start = np.ones((len(x), len(y)), bool)
            if one and a == b:
                start = np.triu(start, 1)
            for earlier in range(band):
                start &= keys[x, earlier][:, None] != keys[y, earlier][None, :]
            pairs = likely_pairs(values[x], values[y], start, threshold, tolerance)
            if len(pairs):
                yield np.stack([x[pairs[:, 0]], y[pairs[:, 1]]], axis=1)


TASK = ["band", "key", "i", "j"]


def _by_task(df: DataFrame, run: Callable[[dict], Iterator], schema) -> DataFrame:
    """``run`` for the rows of each pair of blocks, which lie together in a stream of batches."""
    import pyarrow as pa

    def stream(batches):
        held: list[pa.RecordBatch] = []

        def flush(table):
            yield from run(table)

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [batch.column(c).to_numpy() for c in TASK]
            cuts = np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], axis=0)) + 1
            starts = [0, *cuts.tolist(), batch.num_rows]
            for a, b in zip(starts[:-1], starts[1:]):
                task = tuple(n[a] for n in names)
                if held and task != last:
                    yield from flush(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = task
        if held:
            yield from flush(pa.Table.from_batches(held))

    def packed(batches):
        waiting, size = [], 0
        for out in stream(batches):
            waiting.append(out)
            size += out.num_rows
            if size >= 10_000:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting, size = [], 0
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return df.repartition(*TASK).sortWithinPartitions(*TASK).mapInArrow(packed, schema)


def _matrix(column, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _described(docs: DataFrame, id: str, text: str, words: int, grams: bool) -> DataFrame:
    """``(id, f1, f2, n, sig)`` and, if asked for, ``grams`` per document that has a word; letters count in lower case."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id].dataType
    fields = [T.StructField("id", kind), T.StructField("f1", T.LongType()), T.StructField("f2", T.LongType()), T.StructField("n", T.LongType())]
    fields += [T.StructField("sig", T.BinaryType())]
    fields += [T.StructField("grams", T.BinaryType())] * grams
    arrow = to_arrow_type(kind)

    def run(batches):
        rolling = Rolling(words, 0xC2B2AE3D27D4EB4F)
        for ids, bodies in texts(batches):
            out: list[list] = [[] for _ in fields]
            for i, body in zip(ids, bodies):
                found = shingles(body.decode("utf-8", "replace").lower().encode("utf-8").split(), words, rolling)
                if not len(found):
                    continue
                whole = xxhash.xxh3_128_intdigest(found.tobytes())
                row = [i, (whole >> 64) - (1 << 63), (whole & (1 << 64) - 1) - (1 << 63), len(found), signature(found).tobytes(), found.tobytes()]
                for c, v in zip(out, row):
                    c.append(v)
            kinds = [arrow, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], [f.name for f in fields])

    return id_and_bytes(docs, id, text).mapInArrow(run, T.StructType(fields))


def _tasks(classes: DataFrame) -> DataFrame:
    """``(rep, size, sig, band, key, i, j, side)``: every representative in every pair of blocks of its shared buckets."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            keys = band_keys(_matrix(batch.column("sig"), np.uint32, HASHES)) if batch.num_rows else np.empty((0, BANDS), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("n"), pa.array(list(keys), pa.list_(pa.int64()))], ["rep", "n", "keys"])

    schema = T.StructType([classes.schema["rep"], classes.schema["n"], T.StructField("keys", T.ArrayType(T.LongType()))])
    placed = classes.select("rep", "n", "sig").mapInArrow(run, schema).select("rep", "n", F.posexplode("keys").alias("band", "key"))
    placed = cut(placed, "bands")
    # Written before it is joined: only then can the join split a hot bucket.
    shared = placed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("grams")).where("members > 1")
    shared = cut(shared.select("band", "key", block_count(F.col("members"), F.col("grams")).alias("blocks")), "buckets")
    members = placed.join(shared, ["band", "key"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    per = members.groupBy("rep").agg(F.collect_list(F.struct("band", "key", "blocks", "own")).alias("places"))
    placed = classes.select("rep", "size", "sig").join(per, ["rep"]).select("rep", "size", "sig", F.explode("places").alias("p"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p.blocks") - 1))).select(
        "rep", "size", "sig", "p.band", "p.key", F.least("p.own", "other").alias("i"), F.greatest("p.own", "other").alias("j"),
        (F.col("p.own") > F.col("other")).cast("int").alias("side"),
    )


def _partnered(tasks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """The rows of ``tasks`` that still have a partner after pruning, without signatures."""

    def run(table):
        values = _matrix(table.column("sig"), np.uint32, HASHES)
        stay = np.zeros(len(values), bool)
        for pairs in _candidates(table, values, threshold, tolerance):
            stay[pairs.ravel()] = True
        if stay.any():
            yield from table.drop_columns(["sig"]).take(np.flatnonzero(stay)).combine_chunks().to_batches()

    return _by_task(tasks, run, tasks.drop("sig").schema)


def _verified(tasks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``(rep, links, root)`` per row of ``tasks``, which hold ``grams`` too: documents linked to here, and the smallest member."""
    import pyarrow as pa

    def run(table):
        values = _matrix(table.column("sig"), np.uint32, HASHES)
        grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
        sizes, reps = table.column("size").to_numpy(), table.column("rep").to_pylist()
        links, root = np.zeros(len(reps), np.int64), list(range(len(reps)))

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in (pair for pairs in _candidates(table, values, threshold, tolerance) for pair in pairs.tolist()):
            x, y = grams[a], grams[b]
            if len(x) > len(y):
                x, y = y, x
            if len(x) < threshold * len(y) - 1e-6:
                continue
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            shared = int((y[at] == x).sum())
            if shared / (len(x) + len(y) - shared) >= threshold:
                links[a] += sizes[b]
                links[b] += sizes[a]
                p, q = top(a), top(b)
                if p != q:
                    p, q = (p, q) if reps[p] < reps[q] else (q, p)
                    root[q] = p
        met = np.flatnonzero(links)
        if len(met):
            kind = table.schema.field("rep").type
            yield pa.RecordBatch.from_arrays(
                [pa.array([reps[m] for m in met], kind), pa.array(links[met]), pa.array([reps[top(int(m))] for m in met], kind)], ["rep", "links", "root"]
            )

    schema = T.StructType([tasks.schema["rep"], T.StructField("links", T.LongType()), T.StructField("root", tasks.schema["rep"].dataType)])
    return _by_task(tasks, run, schema)


def near_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, class_id, n_links, copy_of)``.

    Two documents are linked when the Jaccard similarity of their sets of ``words``-word shingles is ``threshold`` or more.
    ``n_links`` counts the other documents a document is linked to, ``copy_of`` is the smallest id with the same set, and
    ``class_id`` the smallest id that chains of links lead to. Words are separated by ASCII white space and compared in lower
    case; a text of fewer words than a shingle is one shingle. Null texts and texts without words have no links and are
    their own class. Ids are expected to be unique: rows that share one count as copies if their sets are equal, and must not
    differ otherwise. Rows with a null id have no links. An empty table gives an empty result.
    """
    known = docs.where(column(id).isNotNull())
    described = cut(_described(known, id, text, words, False), "signatures")
    classes = described.groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = cut(classes, "classes")
    partnered = cut(_partnered(_tasks(classes), threshold, tolerance), "partnered")
    wanted = partnered.groupBy("rep").agg(F.collect_list(F.struct("size", *TASK, "side")).alias("tasks"))
    bodies = known.select(column(id).alias("rep"), column(text).alias("text"))
    if not described.groupBy("id").count().where("count > 1").isEmpty():
        bodies = bodies.dropDuplicates(["rep"])
    chosen = with_results(bodies, wanted.select("rep"), ["rep"], "left_semi")
    sets = _described(chosen, "rep", "text", words, True).select(F.col("id").alias("rep"), "sig", "grams")
    tasks = sets.join(wanted, ["rep"]).select("rep", "sig", "grams", F.explode("tasks").alias("t")).select("rep", "sig", "grams", "t.*")
    verified = cut(_verified(tasks, threshold, tolerance), "links")
    roots = components(verified.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("rep").agg(F.sum("links").alias("links"))
    found = (
        classes.select("f1", "f2", "rep", "size").join(links, ["rep"], "left").join(roots.select(F.col("node").alias("rep"), "root"), ["rep"], "left")
        .select("f1", "f2", "rep", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    )
    placed = described.select("id", "f1", "f2").join(found, ["f1", "f2"]).select(F.col("id").alias("doc_id"), "class_id", "n_links", F.col("rep").alias("copy_of"))
    alone = docs.where(column(id).isNull() | (F.regexp_count(F.coalesce(column(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]")) == 0))
    alone = alone.select(column(id).alias("doc_id"), column(id).alias("class_id"), F.lit(0).cast("long").alias("n_links"), column(id).alias("copy_of"))
    return placed.unionByName(alone)


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class, that of the smallest id, in their own columns; see :func:`near_groups`."""
    gone = near_groups(docs, id, text, **options).where("doc_id <> class_id").select(F.col("doc_id").alias(id)).distinct()
    return with_results(docs, gone, [id], "left_anti")
