"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of a fixed number of characters. The distinct blocks are sorted and get integer names; then
adjacent names are paired, the distinct pairs are sorted and named again, until every document has one name. Equal names on
one level mean equal texts, because names are given to contents and not to hashes: there is no collision to fear.

Only DataFrame functions are used. Block contents are shuffled once, after copies have been merged on the map side; all
later steps move integers. Rows find the name of a block by two 64-bit hashes of it; the table of names, which was made
from contents, shows whether two blocks share both, and then everything is named anew with other hashes.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, cut_measured
from .common import column, fresh, text_of, with_results

BLOCK = 16_384
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str) -> Column:
    """The text with A-Z in lower case and nothing else changed; null counts as empty."""
    return F.translate(text_of(text), UPPER, LOWER)


def _blocks(text: str, block: int) -> Column:
    parts = F.regexp_extract_all(normalised(text), F.lit("(?s).{1,%d}" % block), F.lit(0))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))


def _keys(content: Column, seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(2 * seed), content), F.xxhash64(F.lit(2 * seed + 1), content)


def _named(contents: DataFrame, *keep: Column | str) -> DataFrame:
    """Integer names of distinct rows, by their place in a sort. Written at once, so that each name is given once."""
    ordered = contents.sortWithinPartitions(*contents.columns)
    return cut(ordered.select(*keep, F.monotonically_increasing_id().alias("name")), "names")


def _block_names(docs: DataFrame, text: str, block: int) -> tuple[DataFrame, int]:
    """``(h, g, name)`` of every distinct block, and the seed under which no two blocks share ``(h, g)``."""
    for seed in count():
        h, g = _keys(F.col("b"), seed)
        contents = docs.select(F.explode(_blocks(text, block)).alias("b")).groupBy(h.alias("h"), g.alias("g"), "b").agg(F.lit(0).alias("_"))
        names = _named(contents.select("b", "h", "g"), "h", "g")
        if names.groupBy("h", "g").count().where("count > 1").isEmpty():
            return names, seed


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` with the group of equal texts it belongs to.

    Columns: ``doc_id`` (the type of ``id``), ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, and the identity
    ``(block_level, block_name)``. Equal means identical after A-Z become lower case. The row with the largest id stays;
    a null id is smaller than any other, and of repeated rows one stays. Null texts are empty texts and equal to them.
    An empty table gives an empty result. Other columns are not looked at.
    """
    names, seed = _block_names(docs, text, block)
    keyed = F.transform(_blocks(text, block), lambda b: F.struct(*[k.alias(n) for k, n in zip(_keys(b, seed), "hg")]))
    rows, seen = cut_measured(
        docs.select(
            F.monotonically_increasing_id().alias("row"), column(id).alias("id"), F.sha2(normalised(text), 256).alias("sha"), keyed.alias("blocks"),
        ).withColumn("parts", F.size("blocks")),
        "rows", parts=F.coalesce(F.max("parts"), F.lit(0)),
    )
    level = 0
    state = (
        rows.select("row", "id", "sha", "parts", F.posexplode("blocks").alias("pos", "b")).select("*", F.col("b.h").alias("h"), F.col("b.g").alias("g"))
        .join(names, ["h", "g"]).select("row", "id", "sha", "parts", "pos", "name")
    )
    if seen["parts"] > 1:
        state = cut(state, "level")
    done = _finished(state, level)
    parts = seen["parts"]
    while parts > 1:
        level, parts = level + 1, (parts + 1) // 2
        side = F.col("pos") % 2
        pairs = (
            state.where("parts > 1").groupBy("row", F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.first("id").alias("id"), F.first("sha").alias("sha"), F.shiftright(F.first("parts") + 1, 1).alias("parts"),
                F.max(F.when(side == 0, F.col("name"))).alias("l"), F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("r"),
            )
        )
        pairs = cut(pairs, "pairs")
        names = _named(pairs.select("l", "r").distinct(), "l", "r")
        state = cut(pairs.join(names, ["l", "r"]).select("row", "id", "sha", "parts", "pos", "name"), "level")
        done = done.unionByName(_finished(state, level))
    done = cut(done, "identities")
    # Written before the join, which can then split the rows of a large group.
    groups = cut(done.groupBy("level", "name").agg(F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("size")), "groups")
    return done.join(groups, ["level", "name"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"),
        F.col("level").alias("block_level"), F.col("name").alias("block_name"),
    )


def _finished(state: DataFrame, level: int) -> DataFrame:
    return state.where("parts = 1").select("row", "id", "sha", F.lit(level).alias("level"), "name")


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without all but one of equal texts, in their own columns; the rules are those of :func:`exact_groups`.

    Rows that agree in id and text are one document, whose other columns are taken from any one of them.
    """
    (doc,) = fresh(docs, "_doc")
    found = exact_groups(docs, id, text).where("kept").groupBy(F.col("doc_id").alias("i"), F.col("text_sha256").alias("s")).agg(F.lit(0).alias("_"))
    key = F.struct(column(id).alias("i"), F.sha2(normalised(text), 256).alias("s"))
    once = with_results(docs.withColumn(doc, key), found.select(F.struct("i", "s").alias(doc)), [doc], "left_semi")
    repeated = not docs.groupBy(column(id)).count().where("count > 1").isEmpty()
    return (once.dropDuplicates([doc]) if repeated else once).drop(doc)
