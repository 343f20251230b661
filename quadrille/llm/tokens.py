"""Whole texts to token ids and back, and token counts with an exact histogram of lengths."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .bpe import PIECES, coder, sha256
from .common import column, id_and_bytes, texts

VOCABULARY, PATTERN = "byte_bpe_multi_50k.tiktoken", public_tokenizers.PATTERN
#: Neighbouring lengths whose sums are added up in one task.
LENGTHS = 4096


def _encoded(docs: DataFrame, id: str, text: str, schema: T.StructType, row, vocabulary: str | None, pattern: str, entries: int = PIECES) -> DataFrame:
    """Rows ``(id, *row(coder, text))``; a vocabulary is a path that every executor can read."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    path, arrow = vocabulary or public_tokenizers.path(VOCABULARY), to_arrow_schema(schema)

    def run(batches):
        code = coder(path, pattern, entries)
        for ids, bodies in texts(batches):
            made = [row(code, b.decode("utf-8", "replace")) for b in bodies]
            columns = [ids, *zip(*made)] if made else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return id_and_bytes(docs, id, text).mapInArrow(run, schema)


def _schema(docs: DataFrame, id: str, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField("doc_id", docs.schema[id].dataType), *[T.StructField(n, t) for n, t in fields]])


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", vocabulary: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` per row: ids as little-endian unsigned 32-bit integers, decoded bytes.

    A null text is an empty one and has no ids; repeated rows and null ids are rows like others; an empty table gives an
    empty result. Texts of any length are split span by span.
    """
    schema = _schema(docs, id, ("n_tokens", T.LongType()), ("ids", T.BinaryType()), ("decoded", T.BinaryType()))

    def row(code, text):
        ids = code.encode_bytes(text)
        return len(ids) // 4, ids, code.decode_bytes(ids)

    return _encoded(docs, id, text, schema, row, vocabulary, pattern)


def encode_digests(docs: DataFrame, id: str = "doc_id", text: str = "text", vocabulary: str | None = None, pattern: str = PATTERN, entries: int = PIECES) -> DataFrame:
    """As :func:`encode`, with digests in the place of the bytes: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``.

    ``entries`` bounds the memories of a worker; it changes speed and memory only.
    """
    schema = _schema(docs, id, ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()))

    def row(code, text):
        ids = code.encode_bytes(text)
        return len(ids) // 4, sha256(ids), sha256(code.decode_bytes(ids))

    return _encoded(docs, id, text, schema, row, vocabulary, pattern, entries)


def token_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", vocabulary: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """``(doc_id, n_tokens)`` per row; null texts have none."""
    schema = _schema(docs, id, ("n_tokens", T.LongType()))
    return _encoded(docs, id, text, schema, lambda code, text: (code.count(text),), vocabulary, pattern)


def length_histogram(counts: DataFrame, length: str = "n_tokens", lengths: int = LENGTHS) -> DataFrame:
    """One row per length that occurs, with what suffix sums say about it as a context limit.

    ``n_docs`` documents have exactly ``n_tokens`` tokens; ``docs_at_least`` and ``tokens_at_least`` are the documents
    of this length or more and their tokens; ``truncated_tokens`` is what stays of all tokens when every document is cut to
    this length; ``share_at_most`` is the share of documents that fit whole, so the q-quantile of the lengths is the
    smallest length with a share of q or more. Null lengths are left out; an empty table gives an empty result.

    Lengths are summed in ranges, and ranges over ranges, so no task gets the whole histogram.
    """
    per = counts.where(column(length).isNotNull()).groupBy(column(length).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))
    per = cut(per, "lengths")  # small, and used twice
    per = per.withColumn("_range", F.floor(F.col("n_tokens") / lengths)).withColumn("_tokens", F.col("n_docs") * F.col("n_tokens"))
    after, every = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    ranges = per.groupBy("_range").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t")).select(
        "_range", F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_docs_after"), F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_tokens_after"),
        F.sum("_d").over(every).alias("_docs"), F.sum("_t").over(every).alias("_all"),
    )
    inside = Window.partitionBy("_range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = (
        per.join(ranges, ["_range"]).withColumn("docs_at_least", F.col("_docs_after") + F.sum("n_docs").over(inside))
        .withColumn("tokens_at_least", F.col("_tokens_after") + F.sum("_tokens").over(inside))
    )
    return summed.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        ((F.col("_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("_docs")).alias("share_at_most"),
    )


def answers(histogram: DataFrame, limits: DataFrame, lengths: int = LENGTHS) -> DataFrame:
    """For context limits ``(limit)``: ``docs_over``, ``tokens_over`` (of whole longer documents) and ``truncated_tokens``.

    The limit's answer is that of the next longer length that occurs, corrected by the limit; limits above all lengths cut
    nothing. One row per distinct limit that is not null. The next longer length is looked for in the range of the limit, and else is the first
    one of the next range that has any.
    """
    asked = limits.where("limit IS NOT NULL").select(F.col("limit").cast("long").alias("limit")).distinct()
    total = histogram.agg(F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("all")).first()["all"]
    answer = F.struct("n_tokens", "docs_at_least", "tokens_at_least")
    points = (
        histogram.select("n_tokens", answer.alias("answer"), F.lit(None).cast("long").alias("limit"))
        .unionByName(asked.select((F.col("limit") + 1).alias("n_tokens"), F.lit(None).cast("struct<n_tokens:long,docs_at_least:long,tokens_at_least:long>").alias("answer"), "limit"))
        .withColumn("_range", F.floor(F.col("n_tokens") / lengths))
    )
    later = Window.orderBy("_range").rowsBetween(1, Window.unboundedFollowing)
    ranges = points.groupBy("_range").agg(F.min("answer").alias("first")).select("_range", F.first("first", ignorenulls=True).over(later).alias("_next"))
    ahead = Window.partitionBy("_range").orderBy("n_tokens", F.col("limit").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    found = points.withColumn("_here", F.first("answer", ignorenulls=True).over(ahead)).where("limit IS NOT NULL").join(ranges, ["_range"])
    found = found.withColumn("_at", F.coalesce("_here", "_next"))
    docs, tokens = F.coalesce("_at.docs_at_least", F.lit(0)), F.coalesce("_at.tokens_at_least", F.lit(0))
    return found.select(
        "limit", docs.alias("docs_over"), tokens.alias("tokens_over"), (F.lit(total) - tokens + F.col("limit") * docs).alias("truncated_tokens"),
    )
