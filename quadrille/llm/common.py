"""What the corpus operators share: session settings, tables, words, and joins of whole documents with small results."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import join_lookup, tune

# Results of a document (ids, flags, ranges) are broadcast to the texts up to this measured size, and shuffled beyond it.
RESULT_BYTES = 32 * 1024 * 1024

# A word is a longest run of characters other than ASCII white space (bytes.split() splits UTF-8 in the same places).
WORD = r"[^\x20\x09-\x0D]+"

SETTINGS = {
    # Arrow batches are bounded in bytes, so a run of very long texts does not fill a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its plain name, which may hold dots or spaces."""
    return F.col(f"`{name}`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that are not in ``df``, whatever the case of its names."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (name + "_" * i for i in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def text_of(name: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(column(name), F.lit(""))


def n_words(name: str) -> Column:
    return F.regexp_count(text_of(name), F.lit(WORD)).cast("long")


def with_results(docs: DataFrame, results: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Whole documents with their results, which are far smaller than the texts."""
    return join_lookup(docs, results, on, how, limit=RESULT_BYTES)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Rolling:
    """Hashes of all runs of ``n`` consecutive words, as sums of word hashes times powers of an odd number modulo 2^64.

    Word hashes are 64-bit random values, so two different runs meet with a chance of 2^-64.
    """

    def __init__(self, n: int, base: int):
        self.n, self.base, self.inverse = n, base | 1, pow(base | 1, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    def _powers(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < count:
            size = 1 << (count - 1).bit_length()
            self._up, self._down = (_powers(b, size) for b in (self.base, self.inverse))
        return self._up[:count], self._down[:count]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """One value per run, in order; none where there are fewer than ``n`` words."""
        runs = len(hashes) - self.n + 1
        if runs < 1:
            return np.empty(0, np.uint64)
        up, down = self._powers(len(hashes))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
        return (total[self.n:] - total[:runs]) * down[:runs]


def _powers(base: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    done, step = 1, base
    while done < size:  # out[done:2*done] = out[:done] * base^done
        out[done:2 * done] = out[:done] * np.uint64(step)
        done, step = 2 * done, step * step % (1 << 64)
    return out


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    v = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def texts(batches: Iterator, ids: str = "id", text: str = "text") -> Iterator[tuple[list, list[bytes]]]:
    """Identifiers and UTF-8 texts of Arrow batches; null texts are empty."""
    for batch in batches:
        yield batch.column(ids).to_pylist(), [t or b"" for t in batch.column(text).to_pylist()]


def id_and_bytes(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id`` and ``text`` as bytes, under these names, whatever else the frame holds."""
    return docs.select(column(id).alias("id"), text_of(text).cast("binary").alias("text"))
