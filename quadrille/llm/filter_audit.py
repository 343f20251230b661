"""What filters take out together, alone and in every order.

A document fails a filter or not; which ones it fails is a combination of bits. The filter on repeated texts is an existential
self-join: a left-semi join on a hash, the exact text and a smaller id. Its ids and those of the other failures are united, and the bits
of a row are put together by one aggregation; every order of the filters is then answered from the counts of the combinations alone.

The right side of the self-join has one row per different text, with the least id that has it, so a text of a third of all rows meets one
row and not itself. A hash that only one text has is proof enough of the text; for the others the text itself is joined.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, cut_measured, join_lookup
from .common import column, text_of

Failure = Callable[[Column, Column], Column]

_SPACE = r"[\x20\x09-\x0D]+"

#: Conditions on a text and its words under which the text fails, by the letter of the filter.
FAILURES: dict[str, Failure] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
    "C": lambda text, words: 100 * F.octet_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 2 * F.length(text).cast("long"),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: The filter on texts that a smaller id has too; it comes after the others in the bits.
REPEATED = "E"


def failing_bits(
    docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source",
    failures: dict[str, Failure] | None = None, digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``(id, part, bits)`` per row of ``docs``: bit ``i`` is set when the text fails the ``i``-th filter.

    The last filter fails a text that any row with a smaller id has too. A null text is empty and a null part the empty string. A row
    without an id has no smaller one and is smaller than none; rows that share an id are judged each, and equal ones among them
    do not repeat each other. An empty table gives an empty result. ``digest`` may be any hash: it decides how often texts are
    compared, never the result.
    """
    failures = FAILURES if failures is None else failures

    def described(df: DataFrame) -> DataFrame:
        body = df.select(column(id).alias("id"), F.coalesce(column(part).cast("string"), F.lit("")).alias("part"), text_of(text).alias("body"))
        body = body.withColumn("words", F.array_remove(F.split("body", _SPACE), ""))
        failed = (fails(F.col("body"), F.col("words")) for fails in failures.values())
        bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))
        return body.select(F.monotonically_increasing_id().alias("row"), "id", "part", digest(F.col("body")).alias("hash"), bits.alias("bits"), "body")

    facts = cut(described(docs).drop("body").withColumn("body", F.lit(None).cast("string")), "failures")
    # Hashes that two different ids have, and the texts behind them: one row per text, whatever the number of its copies.
    shared = facts.groupBy("hash").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("hash")
    texts = docs.select(column(id).alias("id"), text_of(text).alias("body")).select("id", digest(F.col("body")).alias("hash"), "body")
    first = join_lookup(texts, shared, ["hash"], "left_semi").groupBy("hash", "body").agg(F.min("id").alias("first"))
    several = F.count(F.lit(1)).over(Window.partitionBy("hash"))
    first, seen = cut_measured(
        first.withColumn("texts", several).select("hash", "first", F.when(F.col("texts") > 1, F.col("body")).alias("body")), "first",
        ambiguous=F.count("body"))
    if seen["ambiguous"]:  # rows under such a hash are described anew, together with their text
        unclear = cut(first.where("body IS NOT NULL").select("hash").distinct(), "ambiguous")
        again = join_lookup(described(docs), unclear, ["hash"], "left_semi").withColumn("row", -1 - F.col("row"))
        facts = cut(join_lookup(facts, unclear, ["hash"], "left_anti").unionByName(again), "failures")
    early = first.select(F.col("hash").alias("its_hash"), "first", F.col("body").alias("its_body"))
    same = (F.col("hash") == F.col("its_hash")) & F.col("body").eqNullSafe(F.col("its_body")) & (F.col("first") < F.col("id"))
    copies = facts.join(early, same, "left_semi")
    last = 1 << len(failures)
    failed = facts.where("bits <> 0").select("row", "bits").unionByName(copies.select("row", F.lit(last).alias("bits")))
    together = failed.groupBy("row").agg(F.sum("bits").cast("int").alias("all_bits"))
    return facts.join(together, "row", "left").select("id", "part", F.coalesce("all_bits", F.lit(0)).alias("bits"))


def audit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source",
    failures: dict[str, Failure] | None = None, repeated: str = REPEATED, digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    One row per part, order of all filters and step, zeros included. ``kept`` and ``removed`` count documents after and at the
    step; ``redundant`` those that fail its filter and were removed earlier; ``unique_fails`` those that fail no other one;
    ``good_lost`` and ``toxic_lost`` the removed ones with quality or toxic 1 in ``labels`` (``id``, ``quality``, ``toxic``; of several
    rows of an id any counts, nulls do not); ``shapley`` what its filter removes, summed over all orders. See :func:`failing_bits` for nulls,
    empty texts, ties and repeated rows. An empty table gives an empty result. Counts are made once per part and combination: at
    most 32 rows of a part for five filters, whatever its share of the documents.
    """
    failures = FAILURES if failures is None else failures
    letters = [*failures, repeated]
    marks = labels.select(column(id).alias("id"), *[(column(c) == 1).cast("int").alias(c) for c in ("quality", "toxic")]).where("id IS NOT NULL")
    marks = marks.groupBy("id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    bits = failing_bits(docs, id, text, part, failures, digest)
    counts = join_lookup(bits, marks, ["id"], "left").groupBy("part", "bits").agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))

    # For each set of filters, how many documents fail none of it; for each filter, how many fail it alone.
    sets = range(1 << len(letters))

    def passing(measure: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("bits").bitwiseAND(s) == 0, F.col(measure)).otherwise(0)) for s in sets])

    alone = F.array(*[F.sum(F.when(F.col("bits") == 1 << i, F.col("docs")).otherwise(0)) for i in range(len(letters))])
    per = counts.groupBy("part").agg(*[passing(m).alias(m) for m in ("docs", "good", "toxic")], alone.alias("alone"))
    shares = [
        sum((_orders(s, len(letters)) * (F.col("docs")[s] - F.col("docs")[s | 1 << i]) for s in sets if not s & 1 << i), F.lit(0))
        for i in range(len(letters))
    ]
    per = per.withColumn("share", F.array(*shares))
    step = F.explode(F.from_json(F.lit(json.dumps(_steps(letters))), "array<struct<o:string,step:int,i:int,before:int,after:int>>"))
    rows = per.withColumn("at", step).select("*", "at.*")

    def lost(measure: str, before: str | int = "before", after: str = "after") -> Column:
        return F.expr(f"{measure}[{before}] - {measure}[{after}]")

    return rows.select(
        "part", F.col("o").alias("filter_order"), "step", F.expr("docs[after]").alias("kept"), lost("docs").alias("removed"),
        (lost("docs", 0, "shiftleft(1, i)") - lost("docs")).alias("redundant"), F.expr("alone[i]").alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.expr("share[i]").alias("shapley"))


def _orders(earlier: int, filters: int) -> int:
    """Orders in which exactly the filters of a set come before a given other one."""
    before = earlier.bit_count()
    return factorial(before) * factorial(filters - 1 - before)


def _steps(letters: list[str]) -> list[dict]:
    """Every order and step: the filter at that step and the sets of filters before and after it."""
    found = []
    for order in permutations(range(len(letters))):
        before = 0
        for step, i in enumerate(order, 1):
            found.append({"o": "".join(letters[j] for j in order), "step": step, "i": i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    return found
