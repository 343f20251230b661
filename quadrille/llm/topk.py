"""Exact top-k inner products by an impact-ordered index, score at a time.

Vectors are dealt into blocks. In a block, each component of each vector is a posting; its size is quantised into levels, and
the postings of one dimension, sign and level are a segment. For a query, segments are processed by descending impact (the
query's component times the largest value of the level) and add the middle of their level to the vectors they hold. What a vector may still
get is bounded by itself: by the norm that is left of it, times the norm that is left of the query on the components it has not been given yet,
plus what its levels blur. A vector whose sum and bound lie below the k-th best sum less its bound is proven not to be a member. Processing stops when scoring
the possible members exactly is less work than the postings that are left; it may stop at any time without changing the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column

K = 10
LEVELS = 256
#: Vectors of a block, and queries that meet it at a time.
BLOCK, QUERIES = 8192, 16384
#: Shares of the postings after which proofs are tried.
STEPS = 16


class ImpactIndex:
    """Segments of one block of integer vectors."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.vectors, self.count = vectors, len(vectors)
        size = np.abs(vectors)
        self.width = np.maximum(1, -(-(size.max(axis=0) + 1) // levels))  # per dimension
        level = size // self.width
        dims = vectors.shape[1]
        # Segment number: dimension, then level, then sign.
        segment = ((np.arange(dims) * levels + level) * 2 + (vectors < 0)).ravel()
        order = np.argsort(segment, kind="stable")
        self.members = (order // dims).astype(np.int32)
        bounds = np.flatnonzero(np.diff(segment[order], prepend=-1))
        number = segment[order][bounds]
        self.start, self.length = bounds, np.diff(np.append(bounds, len(order)))
        self.dim, self.level = number // (2 * levels), number // 2 % levels
        self.middle = (self.level * self.width[self.dim] + (self.width[self.dim] - 1) / 2) * np.where(number % 2, -1, 1)
        self.highest = (self.level + 1) * self.width[self.dim] - 1
        self.lowest = self.level * self.width[self.dim]
        self.norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        self.postings = 0  # processed by the last search

    def search(self, query: np.ndarray, k: int, ids: np.ndarray, own) -> list[tuple[int, int]]:
        """The ``k`` best ``(id, score)`` of the block without ``own``; ties to the smaller id."""
        weight = np.abs(query).astype(float)
        order = np.argsort(-(weight[self.dim] * self.highest), kind="stable")
        need = min(k + int((ids == own).sum()), self.count)
        upto = np.cumsum(self.length[order])
        cuts = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], STEPS + 1)[1:])) + 1
        half = (self.width - 1) / 2
        sums, blur, seen_x, seen_q = (np.zeros(self.count) for _ in range(4))
        length, start, self.postings = float(np.sqrt((weight**2).sum())), 0, 0
        for stop in cuts:
            share = order[start:stop]
            members, dims = self._postings(share)
            times = self.length[share]
            sums += np.bincount(members, np.repeat(query[self.dim[share]] * self.middle[share], times), self.count)
            blur += np.bincount(members, (weight * half)[dims], self.count)
            seen_x += np.bincount(members, np.repeat(self.lowest[share].astype(float) ** 2, times), self.count)
            seen_q += np.bincount(members, (weight**2)[dims], self.count)
            self.postings += len(members)
            start = stop
            rest = np.sqrt(np.maximum(self.norms**2 - seen_x, 0) * np.maximum(length**2 - seen_q, 0))
            bound = rest + blur
            bound += 1e-9 * (np.abs(sums) + bound + self.norms * length) + 1e-6
            least = np.partition(sums - bound, self.count - need)[self.count - need]
            possible = np.flatnonzero(sums + bound >= least)
            if len(possible) * len(query) <= upto[-1] - self.postings or len(possible) <= need:
                break
        possible = possible[ids[possible] != own]
        scores = self.vectors[possible] @ query
        top = np.lexsort((ids[possible], -scores))[:k]
        return list(zip(ids[possible][top].tolist(), scores[top].tolist()))

    def _postings(self, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members of some segments, and the dimension of each posting."""
        length = self.length[segments]
        upto = np.cumsum(length)
        places = np.arange(upto[-1]) + np.repeat(self.start[segments] - upto + length, length)
        return self.members[places], np.repeat(self.dim[segments], length)


def components(vector: Column) -> Column:
    """``floor(1024 * x)`` of each component as an integer; null where the vector or a component is null or not finite."""
    wide = vector.cast("array<double>")
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * 1024)))


def search(
    vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = K, block: int = BLOCK, at_a_time: int = QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of ``vectors`` for each row of ``queries``, both with ``id`` and ``vector``.

    Scores are inner products of integer components. A query does not find rows of its own id. Ties go to the smaller id.
    Rows without an id, null vectors and vectors with null or non-finite components take no part; vectors meet only
    queries of their own length. Repeated candidate rows are found each; a repeated query id is answered once. Empty
    tables give an empty result. Components whose products do not fit 64 bits raise an error.
    """
    import pyarrow as pa

    def ready(df: DataFrame) -> DataFrame:
        found = df.select(column(id).cast("long").alias("id"), components(column(vector)).alias("v"))
        return found.where("id IS NOT NULL AND v IS NOT NULL").withColumn("dims", F.size("v"))

    left, right = ready(vectors), ready(queries).dropDuplicates(["id"])
    blocks = max(1, -(-vectors.count() // block))
    turns = max(1, -(-queries.count() // at_a_time))
    dealt = left.withColumn("block", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks))).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    asked = right.withColumn("turn", F.pmod(F.xxhash64("id"), F.lit(turns)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def matrix(t: pa.Table) -> np.ndarray:
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(t.num_rows, -1).astype(np.int64)

    def meet(key, found: pa.Table, wanted: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if found.num_rows and wanted.num_rows:
            x, q, ids = matrix(found), matrix(wanted), found.column("id").to_numpy()
            if x.shape[1] and float(np.abs(q).max()) * float(np.abs(x).max()) * x.shape[1] >= 2.0**62:
                raise OverflowError("components are too large for 64-bit scores")
            index = ImpactIndex(x) if x.shape[1] else None
            for own, query in zip(wanted.column("id").to_pylist(), q):
                best = index.search(query, k, ids, own) if index else [(i, 0) for i in sorted(ids[ids != own].tolist())[:k]]
                rows += [(own, i, s) for i, s in best]
        return pa.Table.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

    keys = ["block", "turn", "dims"]
    found = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
