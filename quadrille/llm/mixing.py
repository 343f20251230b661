"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets the exponential key ``-ln(u) / w``: ``u`` is a fixed uniform number made from a hash of its id, and ``w``
is its quality weight, so good documents tend to come first. Within a source, documents are sorted by that key and their sizes
are summed up to the source's budget. A budget of one or more whole sources is met by complete epochs first; only the rest
is a selection.

The sort of a hot source is split: Spark cuts sources and keys into ranges of about ``ROWS`` documents at quantiles that it measures, writes
them, sums of ranges are added up over the ranges, and only the documents of one range are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, cut_measured
from .common import column, fresh, n_words, text_of, with_results

#: Sources in code-point order, null last, weigh so much, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: All targets together, as a share of all sizes; and the most that one source gives, in its own sizes.
SHARE, MOST = 1.5, 2.0
ROWS = 10_000
SEED = "mix"


def uniform(id: Column, seed: str = SEED) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a hash of the id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(id.cast("string"), F.lit(""))), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` per source of ``sizes(source, size)``.

    Budgets follow the weights, stop at ``most`` times a source's size, and the excess is shared anew by weight until none is
    above: target = min(most * size, level * weight), where the level makes the targets add up. With sources in the order
    of most * size / weight, it is the largest of the levels found by taking the first k sources as full. One row per
    source is sorted in one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name, by_fill = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("_fill", F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    weighed = (
        per.withColumn("_turn", turn).withColumn("_weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("_turn") + 1))
        .withColumn("_most", most * F.col("source_size")).withColumn("_fill", F.col("_most") / F.col("_weight"))
        .withColumn("_total", share * F.sum("source_size").over(every))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / F.sum("_weight").over(rest))
        .withColumn("_level", F.max("_level").over(every))
    )
    return weighed.select("source", "source_size", F.least("_most", F.col("_level") * F.col("_weight")).alias("target"))


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", quality: DataFrame | None = None,
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, rows: int = ROWS, seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken, text_hash``.

    ``size`` is the number of words, 0 for null and empty texts. ``copies`` says how often the mix takes the document and
    ``taken`` how many words that gives. The document at which a budget ends is taken when that brings the sum nearer to it. ``quality``
    holds ``(doc_id, weight)``, one row per id and weights above 0; other documents weigh 1. Documents with a null source
    are one source. Repeated rows are documents of their own with the same key; rows that share an id are ordered by size and a hash of
    their text, so reruns agree (which of two rows that agree in all of these comes first makes no difference). An empty table gives an empty result.
    """
    sizes = docs.select(column(id).alias("doc_id"), column(source).alias("source"), n_words(text).alias("size"), F.xxhash64(text_of(text)).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    if quality is not None:
        sizes = with_results(sizes, quality.select("doc_id", F.col("weight").alias("_w")), ["doc_id"], "left")
    else:
        sizes = sizes.withColumn("_w", F.lit(1.0))
    key = -F.log(uniform(F.col("doc_id"), seed)) / F.coalesce("_w", F.lit(1.0))
    # A key that is never null, so that the null source joins like any other.
    keyed = sizes.withColumn("_key", key).withColumn("_s", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("_w")
    keyed, seen = cut_measured(keyed, "sizes", rows=F.count(F.lit(1)))
    per = source_targets(keyed, weights, share, most)
    per = per.withColumn("_s", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source")
    parts = max(1, -(-seen["rows"] // rows))
    ranged = keyed.repartitionByRange(parts, "_s", "_key", "doc_id", "size", "_text", "_row").withColumn("_range", F.spark_partition_id())
    placed = cut(ranged, "ranges")
    sums = placed.groupBy("_s", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_s", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_s", "_range").orderBy("_key", "doc_id", "size", "_text", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = with_results(placed, offsets.join(per, ["_s"]), ["_s", "_range"]).withColumn("_upto", F.col("_offset") + F.sum("size").over(inside))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budget = F.col("target") - epochs * F.col("source_size")
    more = (F.col("_upto") - F.col("size") / 2 <= budget).cast("long")
    return (
        summed.withColumn("copies", epochs + F.when(epochs >= most, 0).otherwise(more))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), F.col("_text").alias("text_hash"))
    )


def quality_weights(labels: DataFrame) -> DataFrame:
    """``(doc_id, weight)`` from labels ``(doc_id, quality)``: 2 for quality 1, 0.5 for 0, 1 where unknown; one row per id, the best label counts."""
    best = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return best.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def take(docs: DataFrame, plan: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document as often as the mix takes it, in the columns of ``docs``.

    ``plan`` is what :func:`mix` makes of ``docs``. Rows are told apart by id, size and a hash of the text; a null id is an id like others. Rows
    that agree in all of these take the copies of their group by turns, so that no more is taken than the mix says.
    """
    doc, copies, place, low, more, n = fresh(docs, "_doc", "_copies", "_place", "_low", "_more", "_n")
    whole = {"size", "text_hash"} <= set(plan.columns)  # a plan of ids alone tells rows apart by these

    def key(ident: Column, *rest: Column) -> Column:
        return F.struct(F.coalesce(F.concat(F.lit("="), ident.cast("string")), F.lit("")), *(rest if whole else ())).alias(doc)

    per = plan.groupBy(key(F.col("doc_id"), *(F.col(c) for c in ("size", "text_hash") if whole))).agg(F.sum("copies").alias("all"), F.count(F.lit(1)).alias(n))
    # Of equal rows, ``low`` copies go to each and one more to ``more`` of them.
    per = per.where("all > 0").select(doc, F.floor(F.col("all") / F.col(n)).alias(low), (F.col("all") % F.col(n)).alias(more), n)
    per, seen = cut_measured(per, "copies", repeated=F.coalesce(F.max(n), F.lit(0)))
    found = with_results(docs.withColumn(doc, key(column(id), n_words(text), F.xxhash64(text_of(text)))), per, [doc])
    times = column(low)
    if seen["repeated"] > 1:
        found = found.where(column(n) == 1).withColumn(place, F.lit(1).cast("long")).unionByName(_placed(found.where(column(n) > 1), doc, place))
        times = times + (column(place) <= column(more)).cast("long")
    else:
        times = times + column(more)
    found = found.where(times > 0).withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return found.select(*[column(c) for c in docs.columns])


def _placed(rows: DataFrame, key: str, place: str) -> DataFrame:
    """``rows`` with the place of each among those of its ``key``, from 1: places within a written part, added up over the parts."""
    number, part, before, count = fresh(rows, "_id", "_part", "_before", "_count")
    written = cut(rows.withColumn(number, F.monotonically_increasing_id()), "repeated").withColumn(part, F.shiftright(number, 33))
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy(key, part).agg(F.count(F.lit(1)).alias(count)).withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0))).drop(count)
    inside = F.row_number().over(Window.partitionBy(key, part).orderBy(number))
    return with_results(written, counts, [key, part]).withColumn(place, column(before) + inside).drop(number, part, before)
