"""Terms as 64-bit numbers.

Loops over a graph move numbers instead of text. A number is a hash of the text, so every task finds it by itself and no join is
needed; the dictionary, one row per different term, proves that no two terms share a number, and otherwise another seed is taken. Text
is looked up again for results only.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut


def number(text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), text)


class Numbered:
    """A table with its text columns as numbers, and the dictionary ``(id, term)`` of all of them."""

    def __init__(self, rows: DataFrame, columns: list[str], distinct: bool = True):
        """Without ``distinct`` equal rows stay as they are, which saves a shuffle of all rows where they do no harm."""
        rows = cut(rows.select(*columns), "terms")
        for self.seed in count():
            numbered = rows.select(*[number(F.col(c), self.seed).alias(c) for c in columns])
            each = [rows.select(number(F.col(c), self.seed).alias("id"), F.col(c).alias("term")) for c in columns]
            terms = each[0]
            for more in each[1:]:
                terms = terms.unionByName(more)
            self.terms = cut(terms.distinct(), "dictionary")
            if self.terms.groupBy("id").count().filter("count > 1").isEmpty():
                break
        self.rows = cut(numbered.distinct() if distinct else numbered, "numbers")

    def of(self, df: DataFrame, *columns: str) -> DataFrame:
        """Text columns of another table as numbers; a text that is not in the dictionary may get the number of one that is, see :meth:`known`."""
        return df.select(*[number(F.col(c), self.seed).alias(c) if c in columns else F.col(c) for c in df.columns])

    def known(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose text is in the dictionary, with its number as ``id``."""
        with_id = df.withColumn("id", number(F.col(column), self.seed))
        return with_id.join(self.terms, "id").filter(F.col("term") == F.col(column)).drop("term")

    def text(self, df: DataFrame, *columns: str) -> DataFrame:
        """Numbers of some columns as text again."""
        for c in columns:
            df = df.join(self.terms.select(F.col("id").alias(c), F.col("term").alias("_term")), c).withColumn(c, F.col("_term")).drop("_term")
        return df
