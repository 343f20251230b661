"""Tables, JSON and blobs as input of mappings. The format is always given; nothing is guessed from names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Blanks around a value belong to the value.
WHITESPACE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | str, separator: str = ",",
                   types_as_text: bool = False) -> DataFrame:
    """CSV, TSV or any separator, with a header line that gives the variable names.

    The schema is given, so the files are read once and only for the columns in use. Quotes inside quoted values are
    doubled, and values may span lines. ``types_as_text`` reads every column as text.
    """
    if types_as_text:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    reader = spark.read.schema(schema).option("header", True).option("sep", separator)
    return reader.options(**WHITESPACE).option("escape", '"').option("multiLine", True).option("mode", "FAILFAST").csv(path)


def read_lines_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType | str, separator: str = ",") -> DataFrame:
    """As :func:`read_delimited` for files whose values hold no line breaks: large files are split over many tasks."""
    reader = spark.read.schema(schema).option("header", True).option("sep", separator)
    return reader.options(**WHITESPACE).option("escape", '"').option("mode", "FAILFAST").csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str, documents: bool = False) -> DataFrame:
    """JSON objects, one per line; with ``documents`` each file is one object or array of objects."""
    return spark.read.schema(schema).option("multiLine", documents).option("mode", "FAILFAST").json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1) -> DataFrame:
    """A table or query of a relational database; with a numeric ``partition_column`` read by many tasks."""
    options = dict(url=url, table=table, properties=properties or {})
    if partition_column is not None:
        low, high = bounds
        options.update(column=partition_column, lowerBound=low, upperBound=high, numPartitions=partitions)
    return spark.read.jdbc(**options)


class Sources:
    """Named relational sources: a registry of DataFrames, whatever they are read from."""

    def __init__(self):
        self._sources: dict[str, DataFrame] = {}

    def register(self, name: str, df: DataFrame) -> None:
        if name in self._sources:
            raise ValueError(f"source {name} exists")
        self._sources[name] = df

    def update(self, name: str, df: DataFrame) -> None:
        self.get(name)
        self._sources[name] = df

    def get(self, name: str) -> DataFrame:
        if name not in self._sources:
            raise KeyError(name)
        return self._sources[name]

    def delete(self, name: str) -> None:
        self.get(name)
        del self._sources[name]

    def names(self) -> list[str]:
        return sorted(self._sources)

    def row_counts(self) -> DataFrame:
        """Rows per source, ``(table_name, n_rows)``; each count is its own aggregation."""
        from functools import reduce

        from pyspark.sql import functions as F

        parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in self._sources.items()]
        return reduce(DataFrame.unionByName, parts)


def read_binary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files as documents ``(name, content, length)``; the name is the last part of the path."""
    from pyspark.sql import functions as F

    files = spark.read.format("binaryFile").load(path)
    name = F.url_decode(F.replace(F.regexp_extract("path", "[^/]*$", 0), F.lit("+"), F.lit("%2B")))
    return files.select(name.alias("name"), "content", "length")
