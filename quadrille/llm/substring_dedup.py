"""Substring deduplication with a count-min prefilter.

Every run of ``window`` consecutive words is a window. A word is removed when a window that covers it also starts in a
document with a smaller id.

Counting all windows would move many times the text. So each window is represented by the smallest hash of the short
word runs inside it, its anchor: equal windows have equal anchors, and neighbouring windows mostly share one, which leaves about
one value per twenty words. First pass: partitions count the documents of each anchor into the cells of a count-min sketch, and
the sketches are added up by cell in the shuffle. A window's estimate is that of its anchor, the least of its cells, and is
never below the number of documents that hold the window. Second pass: only windows estimated in two documents or more are
grouped exactly, by 128-bit fingerprints. Nothing is lost by the sketch; too full a sketch would only let more windows through,
so its width follows the number of anchors.

Documents that equal an earlier one word by word are removed whole without looking at their windows; this merges large
groups of copies before anything is shuffled by window.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, cut_measured
from .common import Rolling, column, text_of, with_results, word_hashes

WINDOW = 50
#: Words of the short runs that anchors are chosen from.
RUN = 8
#: Cells of the sketch per anchor, and hash functions.
CELLS, DEPTH = 8, 2


class Windows:
    """Anchors and fingerprints of the windows of a document."""

    def __init__(self, window: int = WINDOW, run: int = RUN):
        self.window, self.span = window, window - min(run, window) + 1
        self._run = Rolling(min(run, window), 0x9E3779B97F4A7C15)
        self._one, self._two = Rolling(window, 0xD6E8FEB86659FD93), Rolling(window, 0xA0761D6478BD642F)

    def anchors(self, hashes: np.ndarray) -> np.ndarray:
        """One anchor per window."""
        if len(hashes) < self.window:
            return np.empty(0, np.uint64)
        low, reach = self._run(hashes), 1
        while 2 * reach <= self.span:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        rest = self.span - reach
        return np.minimum(low[:-rest], low[rest:]) if rest else low

    def fingerprints(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = hashes ^ (hashes >> np.uint64(29)) ^ (hashes << np.uint64(17))
        return self._one(hashes), self._two(turned)


def _signed(values: np.ndarray):
    return values.view(np.int64)


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``(id, k, text)`` of all rows. Rows of one id may differ in their texts, so a document is told by its id and a hash of its text."""
    return docs.select(column(id).alias("id"), F.hash(text_of(text)).alias("k"), text_of(text).cast("binary").alias("text"))


def _prints(docs: DataFrame, id: str, text: str, window: int) -> DataFrame:
    """``(id, k, f1, f2, anchors)`` of documents with at least one window: a fingerprint of all words, and the distinct anchors."""
    import pyarrow as pa

    kind = docs.schema[id].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("k", T.IntegerType()), T.StructField("f1", T.LongType()), T.StructField("f2", T.LongType()), T.StructField("anchors", T.ArrayType(T.LongType()))])

    def run(batches):
        windows = Windows(window)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for i, k, body in zip(*(batch.column(c).to_pylist() for c in ("id", "k", "text"))):
                words = body.split()
                if len(words) >= window:
                    whole = xxhash.xxh3_128_intdigest(b" ".join(words))
                    out[0].append(i)
                    out[1].append(k)
                    out[2].append((whole >> 64) - (1 << 63))
                    out[3].append((whole & (1 << 64) - 1) - (1 << 63))
                    out[4].append(_signed(np.unique(windows.anchors(word_hashes(words)))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (batch_type, pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                ["id", "k", "f1", "f2", "anchors"],
            )

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(kind)
    known = docs.where(column(id).isNotNull())
    return _keyed(known, id, text).mapInArrow(run, schema)


def _estimated_repeated(anchors: DataFrame, total: int) -> DataFrame:
    """``(id, k, anchor)`` of anchors whose estimate is two documents or more."""
    width = 1 << max(10, (CELLS * total - 1).bit_length())
    cells = [F.xxhash64(F.lit(d), "anchor").bitwiseAND(F.lit(width - 1)).alias(f"c{d}") for d in range(DEPTH)]
    placed = anchors.select("id", "k", "anchor", *cells)
    # Partial sums are the sketches of partitions, without their empty cells; the shuffle adds them up.
    sketch = placed.select(F.posexplode(F.array(*[f"c{d}" for d in range(DEPTH)])).alias("row", "cell")).groupBy("row", "cell").agg(F.count(F.lit(1)).alias("n"))
    full = cut(sketch.where("n >= 2").select("row", "cell"), "sketch")
    for d in range(DEPTH):
        placed = placed.join(full.where(F.col("row") == d).select(F.col("cell").alias(f"c{d}")), [f"c{d}"], "left_semi")
    return placed.select("id", "k", "anchor")


def _windows(docs: DataFrame, id: str, text: str, flags: DataFrame, window: int) -> DataFrame:
    """``(w1, w2, id, k, pos)`` of the windows whose anchor is among the document's flagged ones."""
    import pyarrow as pa

    kind = docs.schema[id].dataType
    schema = T.StructType([T.StructField("w1", T.LongType()), T.StructField("w2", T.LongType()), T.StructField("id", kind), T.StructField("k", T.IntegerType()), T.StructField("pos", T.IntegerType())])

    def run(batches):
        windows = Windows(window)
        for batch in batches:
            found = []
            for row, (body, flagged) in enumerate(zip(batch.column("text").to_pylist(), batch.column("flagged"))):
                hashes = word_hashes((body or b"").split())
                at = np.flatnonzero(np.isin(windows.anchors(hashes), flagged.values.to_numpy().view(np.uint64)))
                w1, w2 = windows.fingerprints(hashes)
                found.append((_signed(w1[at]), _signed(w2[at]), np.full(len(at), row), at.astype(np.int32)))
            if found:
                w1, w2, rows, at = map(np.concatenate, zip(*found))
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1), pa.array(w2), batch.column("id").take(rows), batch.column("k").take(rows), pa.array(at)], ["w1", "w2", "id", "k", "pos"]
                )

    return with_results(_keyed(docs, id, text), flags, ["id", "k"]).select("id", "k", "text", "flagged").mapInArrow(run, schema)


def _ranges(hits: DataFrame, window: int) -> DataFrame:
    """``(id, k, starts, ends)``: the words covered by the windows that start at ``hits(id, k, pos)``, as runs."""
    import pyarrow as pa

    fields = T.StructType([hits.schema["id"], hits.schema["k"], T.StructField("starts", T.ArrayType(T.IntegerType())), T.StructField("ends", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            starts, ends = [], []
            for places in batch.column("places"):
                p = np.sort(places.values.to_numpy())
                gap = np.flatnonzero(np.diff(p) > window)
                starts.append(p[np.append(0, gap + 1)])
                ends.append(p[np.append(gap, len(p) - 1)] + window)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("k"), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], ["id", "k", "starts", "ends"]
            )

    return hits.groupBy("id", "k").agg(F.collect_set("pos").alias("places")).mapInArrow(run, fields)


def repeated_words(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(id, k, whole, starts, ends)`` per document that loses words: all of them, or the words from each start to before its end."""
    prints, seen = cut_measured(_prints(docs, id, text, window), "prints", anchors=F.coalesce(F.sum(F.size("anchors")), F.lit(0)))
    # Grouped results are written before they are joined with their rows: only then can the join split a hot key.
    first = cut(prints.groupBy("f1", "f2").agg(F.min("id").alias("first")), "first")
    placed = cut(prints.join(first, ["f1", "f2"]).select("id", "k", (F.col("id") > F.col("first")).alias("copy"), "anchors"), "placed")
    anchors = placed.where("NOT copy").select("id", "k", F.explode("anchors").alias("anchor"))
    flags = _estimated_repeated(anchors, seen["anchors"]).groupBy("id", "k").agg(F.collect_set("anchor").alias("flagged"))
    found = cut(_windows(docs, id, text, flags, window), "windows")
    least = cut(found.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most"), "least")
    hits = found.join(least, ["w1", "w2"]).where("id > least").select("id", "k", "pos")
    none = F.array().cast("array<int>")
    whole = placed.where("copy").select("id", "k", F.lit(True).alias("whole"), none.alias("starts"), none.alias("ends")).dropDuplicates(["id", "k"])
    return _ranges(hits, window).select("id", "k", F.lit(False).alias("whole"), "starts", "ends").unionByName(whole)


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` per row of ``docs``; ``kept`` are the remaining words with one space between.

    Words are runs of characters other than ASCII white space; null texts have none. Windows are judged on the input, not on
    what is left. Documents shorter than a window lose nothing. Rows with a null id are returned whole and remove
    nothing elsewhere; rows with the same id do not remove each other's words. An empty table gives an empty result.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            counts, removed, kept = [], [], []
            for body, whole, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "whole", "starts", "ends"))):
                words = (body or b"").split()
                counts.append(len(words))
                if whole:
                    rest: list[bytes] = []
                elif starts:
                    rest, upto = [], 0
                    for a, b in zip(starts, ends):
                        rest += words[upto:a]
                        upto = b
                    rest += words[upto:]
                else:
                    rest = words
                removed.append(len(words) - len(rest))
                kept.append(b" ".join(rest))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], schema=arrow)

    found = with_results(_keyed(docs, id, text), repeated_words(docs, id, text, window), ["id", "k"], "left")
    return found.select("id", "text", "whole", "starts", "ends").mapInArrow(run, schema)
