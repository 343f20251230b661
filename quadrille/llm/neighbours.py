"""Approximate nearest neighbours by inner product: multiprobe hashing with p-stable functions.

Rows are scaled by the longest of them and get one more component that makes all of them equally long; queries get length one. Then
the largest inner product is the smallest Euclidean distance, for which ``floor((a . x + b) / width)`` with normal ``a`` is locality
sensitive. A bucket of a table is the values of its functions. A query does not only look into its own bucket of each table but
into those reached by stepping over the nearest borders, in the order of the summed squared distances to the borders crossed, which is
the estimated order of success. Candidates of all tables are merged, scored exactly on the original vectors and ranked.

Each different vector is indexed once, with as many of its ids as an answer can hold; it is known by its least id and a hash. Buckets of more than ``CHUNK`` vectors are
cut into pieces, and pieces that many queries visit are visited in turns; nothing is left out of a bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, cut_measured, join_lookup
from .common import column, mixed

K = 20
TABLES = 4
#: Share of the true neighbours of the sampled queries that must be found; of these queries, and of the rows used to tell costs, there are at most so many.
GOAL, SAMPLE_QUERIES, SAMPLE_ROWS = 0.97, 64, 2048
#: Functions of a table at most, widths tried (projections have deviation one), buckets visited in a table at most, rows a bucket should have.
FUNCTIONS, WIDTHS, PROBES, ROWS_PER_BUCKET = 16, (1.0, 1.5, 2.0), 256, 64
#: Vectors of a group of buckets, vectors of a piece of a large bucket, queries that visit a group or piece at a time.
PART, CHUNK, TURN = 16384, 4096, 16384
#: A visited bucket costs as much as scoring so many vectors.
VISIT = 8
SEED = 20


@dataclass(frozen=True)
class Family:
    """The functions of all tables: directions, offsets in widths, width, and the longest row."""

    directions: np.ndarray  # table, function, dimension
    offsets: np.ndarray
    width: float
    longest: float

    @classmethod
    def drawn(cls, dims: int, tables: int, functions: int, width: float, longest: float, seed: int = SEED) -> Family:
        rng = np.random.default_rng([seed, dims])
        directions, offsets = rng.normal(size=(tables, FUNCTIONS, dims + 1)), rng.random((tables, FUNCTIONS))
        return cls(directions[:, :functions], offsets[:, :functions], width, longest)

    def _values(self, points: np.ndarray, table: int) -> np.ndarray:
        return points @ self.directions[table].T / self.width + self.offsets[table]

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        points = vectors / self.longest
        points = np.column_stack([points, np.sqrt(np.maximum(0, 1 - (points * points).sum(1)))])
        return np.stack([_named(np.floor(self._values(points, t)), t).sum(1, dtype=np.uint64) for t in range(len(self.directions))], axis=1)

    def probes(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The first ``count`` buckets of each table for each query (query, table, place), by estimated success.

        The steps of one function after the other are added to the best sums so far. Costs add up and none is negative, so the best
        ``count`` sums of some functions are all that the best ``count`` of more functions can come from.
        """
        length = np.sqrt((vectors * vectors).sum(1, keepdims=True))
        points = np.column_stack([vectors / length, np.zeros(len(vectors))])
        return np.stack([self._order(self._values(points, t), t, count) for t in range(len(self.directions))], axis=1)

    @staticmethod
    def _order(values: np.ndarray, table: int, count: int) -> np.ndarray:
        places = np.floor(values)
        inside = values - places
        steps = np.array([0, -1, 1, -2, 2])
        away = np.stack([0 * inside, inside, 1 - inside, 1 + inside, 2 - inside], axis=2) ** 2  # query, function, step
        cost, name = np.zeros((len(values), 1)), np.zeros((len(values), 1), np.uint64)
        for f in range(values.shape[1]):
            named = _named(places[:, f, None] + steps, table, f)
            cost = (cost[:, :, None] + away[:, f, None]).reshape(len(values), -1)
            name = (name[:, :, None] + named[:, None]).reshape(len(values), -1)
            if cost.shape[1] > count:
                best = np.argpartition(cost, count - 1, axis=1)[:, :count]
                cost, name = np.take_along_axis(cost, best, 1), np.take_along_axis(name, best, 1)
        return np.take_along_axis(name, np.argsort(cost, axis=1, kind="stable"), 1)


def _named(places: np.ndarray, table: int, function: int | None = None) -> np.ndarray:
    """A 64-bit name of each place of a function (columns are functions unless one is given); the sum of names is the bucket."""
    functions = np.arange(places.shape[1]) if function is None else np.array([function])
    salt = mixed(functions.astype(np.uint64) + np.uint64(1 + (table << 20)))
    return mixed(places.astype(np.int64).astype(np.uint64) ^ salt)


def fitted(neighbours: list[np.ndarray], queries: np.ndarray, rows: np.ndarray, total: int, longest: float, tables: int = TABLES, goal: float = GOAL) -> tuple[Family, int]:
    """The family and number of probes that reach ``goal`` on the sample at the least cost.

    ``neighbours`` are the true nearest rows of each sampled query. Finer buckets are tried first; with fewer and fewer functions a
    query sees all rows in the end, so the goal is always reached.
    """
    dims = queries.shape[1]
    finest = int(np.clip(np.ceil(np.log2(max(total / ROWS_PER_BUCKET, 2))), 2, FUNCTIONS))
    best = None
    for functions in range(finest, -1, -1):
        for width in WIDTHS:
            family = Family.drawn(dims, tables, functions, width, longest)
            probes = family.probes(queries, PROBES)
            place = _places(probes, [family.rows(n) for n in neighbours])
            first = np.sort(np.concatenate([p.min(axis=1) for p in place]))
            need = int(first[min(len(first), int(np.ceil(goal * len(first)))) - 1]) + 1
            if need > probes.shape[2]:
                continue
            hits = np.concatenate([(p < need).sum(axis=1) for p in _places(probes, [family.rows(rows)] * len(queries))])
            cost = hits.mean() * total + VISIT * tables * need
            if best is None or cost < best[0]:
                best = cost, family, need
        if best is not None and functions <= finest // 2:
            break
    return best[1], best[2]


def _places(probes: np.ndarray, buckets: list[np.ndarray]) -> list[np.ndarray]:
    """For each query, where in its probes each row's bucket stands (row, table); beyond the end if nowhere."""
    found = []
    for probe, bucket in zip(probes, buckets):
        place = np.full(bucket.shape, np.iinfo(np.int32).max)
        for t in range(bucket.shape[1]):
            order = np.argsort(probe[t], kind="stable")
            at = np.minimum(np.searchsorted(probe[t][order], bucket[:, t]), len(order) - 1)
            hit = probe[t][order][at] == bucket[:, t]
            place[hit, t] = order[at[hit]]
        found.append(place)
    return found


def _usable(df: DataFrame, id: str, vector: str) -> DataFrame:
    kind = df.schema[vector].dataType.simpleString()
    entries = column(vector) if kind == "array<float>" else column(vector).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return df.select(column(id).cast("long").alias("id"), entries.alias("v")).where(F.col("id").isNotNull() & fine).withColumn("dims", F.size("v"))


def _matrix(batch, name: str = "v") -> np.ndarray:
    import pyarrow as pa

    lists = batch.column(name)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)


def _scored(q: np.ndarray, x: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Inner products of pairs; the same pair of vectors has the same score wherever it is met."""
    return np.concatenate([(q[at[i:i + 65536]] * x[to[i:i + 65536]]).sum(1) for i in range(0, max(len(at), 1), 65536)])


def _best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, pairs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best ``(query, row, score)`` of each query among ``pairs``: queries and a range of rows that they meet."""
    found: list[tuple] = []
    for asked, start, stop in pairs:
        for i in range(0, len(asked), 1024):
            some = asked[i:i + 1024]
            near = q[some] @ x[start:stop].T
            if stop - start > k:  # products of matrices round differently by place: keep what may be equal
                least = np.partition(near, stop - start - k, axis=1)[:, stop - start - k, None]
                keep = near >= least - 1e-12 * (1 + np.abs(least))
            else:
                keep = np.ones(near.shape, bool)
            at, to = np.nonzero(keep)
            found.append((some[at], to + start))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    at, to = (np.concatenate(c) for c in zip(*found))
    score = _scored(q, x, at, to)
    order = np.lexsort((ids[to], -score, at))
    at, to, score = at[order], to[order], score[order]
    begins = np.flatnonzero(np.diff(at, prepend=-1))
    rank = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
    return at[rank < k], to[rank < k], score[rank < k]


def _visited(rows: DataFrame, asked: DataFrame, total: int, k: int, part: int, chunk: int, turn: int) -> DataFrame:
    """``(query_id, rep, code, score)``: the ``k`` best that each query finds in each group of the buckets it visits.

    ``rows`` are ``(rep, code, v, dims, buckets)`` with a bucket per table, ``asked`` are ``(query_id, v, dims, probes)`` with a list of buckets per table.
    """
    import pyarrow as pa

    held = rows.select("dims", "rep", "code", "v", F.posexplode("buckets").alias("tbl", "bucket"))
    size = held.groupBy("dims", "tbl", "bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > chunk)
    large, seen = cut_measured(size.select("dims", "tbl", "bucket", F.ceil(F.col("size") / chunk).cast("int").alias("pieces")), "large")
    small = seen["bytes"] <= 64 << 20
    group = F.when(F.col("pieces").isNull(), F.pmod("bucket", F.lit(max(1, -(-total // part))))).otherwise(F.col("bucket")).alias("part")
    at = ["dims", "tbl", "bucket"]
    piece = F.when(F.col("pieces").isNull(), 0).otherwise(1 + F.pmod(F.col("code"), F.col("pieces"))).cast("int").alias("piece")
    held = join_lookup(held, large, at, "left", small=small).select("dims", "tbl", group, piece, "bucket", "rep", "code", "v")
    probes = asked.select("dims", "query_id", F.posexplode("probes").alias("tbl", "probe")).select("dims", "query_id", "tbl", F.explode("probe").alias("bucket"))
    pieces = F.explode(F.when(F.col("pieces").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.col("pieces")))).alias("piece")
    key = ["dims", "tbl", "part", "piece"]
    visits = join_lookup(probes, large, at, "left", small=small).select("dims", "query_id", "tbl", group, "bucket", pieces)
    visits = cut(visits.groupBy("query_id", *key).agg(F.collect_list("bucket").alias("probe")), "visits")
    crowd = visits.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > turn)
    crowd, seen = cut_measured(crowd.select(*key, F.ceil(F.col("n") / turn).cast("int").alias("turns")), "crowd")
    small = seen["bytes"] <= 64 << 20
    turns = F.coalesce("turns", F.lit(1))
    visits = join_lookup(visits, crowd, key, "left", small=small).withColumn("turn", F.pmod(F.xxhash64("query_id"), turns).cast("int")).drop("turns")
    held = join_lookup(held, crowd, key, "left", small=small).withColumn("turn", F.explode(F.sequence(F.lit(0), turns - 1))).drop("turns")
    visits = visits.join(asked.select("query_id", "v"), "query_id")

    def meet(key, found: pa.Table, wanted: pa.Table) -> pa.Table:
        at = to = ids = codes = names = np.empty(0, np.int64)
        score = np.empty(0)
        if found.num_rows and wanted.num_rows:
            bucket = found.column("bucket").to_numpy()
            order = np.argsort(bucket, kind="stable")
            x, bucket = _matrix(found)[order], bucket[order]
            ids, codes = (found.column(c).to_numpy()[order] for c in ("rep", "code"))
            starts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
            ends = np.append(starts[1:], len(bucket))
            lists = wanted.column("probe").combine_chunks()
            probed = lists.flatten().to_numpy()
            who = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            place = np.minimum(np.searchsorted(bucket[starts], probed), len(starts) - 1)
            hit = bucket[starts][place] == probed
            who, place = who[hit], place[hit]
            by = np.argsort(place, kind="stable")
            who, place = who[by], place[by]
            cuts = np.flatnonzero(np.diff(place, prepend=-1))
            visitors = np.split(who, cuts[1:]) if len(cuts) else []
            pairs = ((v, starts[p], ends[p]) for v, p in zip(visitors, place[cuts]))
            with np.errstate(all="ignore"):
                at, to, score = _best(_matrix(wanted), x, ids, k, pairs)
            names = wanted.column("query_id").to_numpy()
        return pa.table({"query_id": pa.array(names[at], pa.int64()), "rep": pa.array(ids[to], pa.int64()), "code": pa.array(codes[to], pa.int64()), "score": pa.array(score, pa.float64())})

    key = [*key, "turn"]
    return held.groupBy(*key).cogroup(visits.groupBy(*key)).applyInArrow(meet, "query_id long, rep long, code long, score double")


def _nearest_of_sample(rows: DataFrame, sample: np.ndarray, k: int) -> list[np.ndarray]:
    """The ``k`` best rows of each sampled query over all rows: each task sends its own ``k`` best."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            x = _matrix(batch)
            everyone = [(np.arange(len(sample)), 0, len(x))] if len(x) else []
            at, to, score = _best(sample, x, np.arange(len(x)), k, everyone)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(score), pa.array(list(x[to]), pa.list_(pa.float64()))], ["q", "score", "v"])

    best = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    found = rows.select("v").mapInArrow(run, "q long, score double, v array<double>").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    near: list[list] = [[] for _ in sample]
    for r in found.collect():
        near[r["q"]].append(r["v"])
    return [np.array(n).reshape(len(n), -1) for n in near]


def search(
    vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = K, tables: int = TABLES, goal: float = GOAL,
    part: int = PART, chunk: int = CHUNK, turn: int = TURN,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of ``vectors`` for each row of ``queries``, both with ``id`` and ``vector``.

    Nearest has the largest inner product, in double precision; ties go to the smaller id. A query does not find rows of its own
    id. Rows without an id, null and zero vectors, and vectors with null or non-finite entries take no part; vectors meet only
    queries of their own length, and those of another length than most rows have are searched in full. Repeated rows of an id and
    vector count once, rows of one id with different vectors each; a query id with several vectors is answered for the least of them. A
    query that finds fewer than ``k`` is searched in full too. Empty tables give an empty result.

    The family of functions is fitted on at most ``SAMPLE_QUERIES`` queries, with their true neighbours among all rows, and ``SAMPLE_ROWS`` rows.
    """
    import pyarrow as pa

    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = _usable(vectors, id, vector).distinct()
    same = Window.partitionBy("v").orderBy("id")
    members = usable.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1)
    members = cut(members.withColumn("rep", F.first("id").over(same)).withColumn("code", F.xxhash64("v")), "members")
    classes = members.where("place = 1").select("rep", "code", "v", "dims")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    common = classes.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("longest")).orderBy(F.desc("n"), "dims").limit(1).collect()
    asked = _usable(queries, id, vector).groupBy("id").agg(F.min("v").alias("v")).select(F.col("id").alias("query_id"), "v", F.size("v").alias("dims"))
    if not common:
        return empty
    dims, total, longest = common[0]["dims"], common[0]["n"], common[0]["longest"]
    chosen = asked.where(F.col("dims") == dims).orderBy(F.xxhash64("query_id"), "query_id").limit(SAMPLE_QUERIES).collect()
    family, probes = Family.drawn(dims, tables, 0, 1.0, longest), 1
    if chosen:
        sample = np.array([r["v"] for r in chosen], float)
        seen = classes.where(F.col("dims") == dims)
        some = np.array([r["v"] for r in seen.orderBy("code").limit(SAMPLE_ROWS).collect()], float)
        family, probes = fitted(_nearest_of_sample(seen, sample, k), sample, some, total, longest, tables, goal)

    def named(batches, query: bool):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                block = batch.slice(start, 512)
                kinds = block.column("dims").to_numpy()
                usual = np.flatnonzero(kinds == dims)
                buckets = [[[0]] if query else [0]] * block.num_rows
                if len(usual):
                    x = _matrix(block.take(pa.array(usual)))
                    with np.errstate(all="ignore"):
                        found = (family.probes(x, probes) if query else family.rows(x)).view(np.int64).tolist()
                    for i, b in zip(usual, found):
                        buckets[i] = b
                kind = pa.list_(pa.list_(pa.int64())) if query else pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(buckets, kind)], [*block.schema.names, "probes" if query else "buckets"])

    wide = classes.schema["v"].dataType.simpleString()
    rows = cut(classes.mapInArrow(lambda b: named(b, False), f"rep long, code long, v {wide}, dims int, buckets array<long>"), "buckets")
    asked_wide = asked.schema["v"].dataType.simpleString()
    visits = cut(asked.mapInArrow(lambda b: named(b, True), f"query_id long, v {asked_wide}, dims int, probes array<array<long>>"), "probes")
    met = _merged(_visited(rows, visits, total, k + 1, part, chunk, turn), members, k)
    found = cut(met, "found")
    enough = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    short, few = cut_measured(visits.join(enough, "query_id", "left_anti").where(F.col("dims") == dims), "short", rows=F.count(F.lit(1)))
    if not few["rows"]:
        return found
    everything = rows.where(F.col("dims") == dims).withColumn("buckets", F.array(F.lit(0).cast("long")))
    whole = short.withColumn("probes", F.array(F.array(F.lit(0).cast("long"))))
    again = _merged(_visited(everything, whole, total, k + 1, part, chunk, turn), members, k)
    return found.join(short.select("query_id"), "query_id", "left_anti").unionByName(again)


def _merged(met: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The best of all groups and tables, each vector with the ids that have it."""
    best = met.groupBy("query_id", "rep", "code").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "rep", "code"))
    best = best.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    found = best.join(members.select("rep", "code", F.col("id").alias("vec_id")), ["rep", "code"]).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
