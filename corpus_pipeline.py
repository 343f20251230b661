"""A pipeline over the documents: language, copies, near copies, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before has kept, which is written as Parquet and read again.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quadrille.llm.common import prepare, table  # noqa: E402
from quadrille.llm.exact_dedup import drop_copies  # noqa: E402
from quadrille.llm.langid import keep_identified, learn  # noqa: E402
from quadrille.llm.mixing import mix, quality_weights, take  # noqa: E402
from quadrille.llm.near_join import drop_near_copies  # noqa: E402
from quadrille.llm.tokens import encode_digests  # noqa: E402
from quadrille.session import remove, scope, scratch  # noqa: E402


#: Arrow batches are smaller than those of single operators: workers of five stages live side by side on an executor.
BATCH = "8m"
#: For the same reason the encoder remembers fewer words than it does alone.
ENTRIES = 80_000


def _ready(spark: SparkSession) -> SparkSession:
    prepare(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    return spark


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter, and those too far from every profile, go.

    Null and empty texts have no letter. Rows with a null label are judged, not learnt from; repeated rows and null ids are rows like
    others. An empty table stays empty. Other columns pass through, whatever their names.
    """
    _ready(spark)
    return keep_identified(docs, learn(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts, that of the largest id.

    A null text is an empty one and a null id the smallest. Rows that agree in id and text are one document, whose other columns are those of any
    of them. An empty table stays empty. Other columns pass through, whatever their names.
    """
    _ready(spark)
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id.

    Texts of fewer than five words, null and empty ones are near no other text. Rows that share the id that stays are kept together. An empty
    table stays empty. Other columns pass through, whatever their names.
    """
    _ready(spark)
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it.

    A null source is a source of its own, and null and empty texts have the size 0. Rows that share an id are told apart by size and text; equal
    rows share their copies by turns. An empty table stays empty. Other columns pass through, whatever their names.
    """
    return take(docs, mix(docs, quality=quality_weights(table(spark, sf_dir, "labels"))))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, a row for each time a document is taken.

    A null text is an empty one: no tokens, digests of nothing. Repeated rows and null ids are rows like others. An empty table gives an empty
    result. Other columns are not looked at.
    """
    _ready(spark)
    return encode_digests(docs, entries=ENTRIES)


STAGES = [
    ("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("encoding", encoding),
]

#: Profiles, shingles and merges are beyond SQL; ``tests/llm/test_llm_pipeline.py`` holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage writes on its way is deleted when its result stands, and that when the next one's does."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, name)
        with scope(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
