"""IRIs: templates, prefixes, relative references, local names."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import join_lookup

# Fixed value: characters a template value keeps as they are (unreserved ASCII; all non-ASCII text stays too).
UNRESERVED = r"^[A-Za-z0-9._~-]*$"

# Text of a whole number as a cast writes it; up to SAFE_DIGITS characters it fits a long for sure.
WHOLE_NUMBER = r"0|-?[1-9]\d*"
SAFE_DIGITS = 18


def encode_iri_part(col: Column) -> Column:
    """Percent-encode a value for an IRI. Plain values take the short way, others go character by character."""

    def one(ch: Column) -> Column:
        encoded = F.replace(F.replace(F.url_encode(ch), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
        return F.when(ch.rlike(r"[A-Za-z0-9._~-]|[^\x00-\x7F]"), ch).otherwise(encoded)

    chars = F.regexp_extract_all(col, F.lit("(?s)(.)"), F.lit(1))
    return F.when(col.rlike(UNRESERVED), col).otherwise(F.array_join(F.transform(chars, one), ""))


@dataclass(frozen=True)
class Template:
    """An IRI template such as ``http://example.org/Album{id}`` over the columns of a source."""

    text: str
    bnode: bool = False

    @cached_property
    def parts(self) -> list[str]:
        return re.split(r"\{([^{}]+)\}", self.text)

    @property
    def columns(self) -> list[str]:
        return self.parts[1::2]

    @property
    def head(self) -> str:
        """The fixed text before the first column."""
        return ("_:" if self.bnode else "") + self.parts[0]

    def column(self, schema: T.StructType) -> Column:
        """The IRI; NULL when a column is NULL."""
        out = []
        for i, part in enumerate(self.parts):
            if i % 2:
                col = F.col(f"`{part}`")
                text = isinstance(schema[part].dataType, T.StringType)
                out.append(encode_iri_part(col) if text else col.cast("string"))
            elif part:
                out.append(F.lit(part))
        if self.bnode:
            out.insert(0, F.lit("_:"))
        return F.concat(*out)

    def matches(self, iri: str, schema: T.StructType) -> Column | None:
        """Condition on the source columns for ``template = iri``; None when no row can match.

        A template of one column is turned into a comparison of that column, which reaches the file scan.
        """
        prefix, suffix = self.head, self.parts[-1] if len(self.parts) > 1 else ""
        if not iri.startswith(prefix) or not iri.endswith(suffix):
            return None
        if len(self.columns) == 1:
            value = iri[len(prefix) : len(iri) - len(suffix)]
            kind = schema[self.columns[0]].dataType
            col = F.col(f"`{self.columns[0]}`")
            if isinstance(kind, T.IntegralType) and not re.fullmatch(WHOLE_NUMBER, value):
                return None
            if isinstance(kind, T.IntegralType) and len(value) <= SAFE_DIGITS:
                return col == int(value)
            if isinstance(kind, T.StringType) and re.fullmatch(UNRESERVED, value):
                return col == value
        return self.column(schema) == iri


def local_name(col: Column) -> Column:
    """The last segment of an IRI, after '/' or '#'."""
    return F.regexp_extract(col, r"[^/#]*$", 0)


def resolve(col: Column, base: Column | str) -> Column:
    """A relative reference against a base IRI (RFC 3986, section 5.2).

    ``//host``, ``/path``, ``?query``, ``#fragment``, the empty reference and relative paths are joined to the part of the base they
    replace, and dot segments are taken out of the path. Absolute IRIs and blank nodes stay as they are.
    """
    base = F.lit(base) if isinstance(base, str) else base
    shape = r"^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?"
    scheme, host, path, query = (F.coalesce(F.regexp_extract(base, shape, i), F.lit("")) for i in (1, 2, 3, 4))
    folder = F.when((F.regexp_extract(path, "^.*/", 0) == "") & (host != ""), "/").otherwise(F.regexp_extract(path, "^.*/", 0))
    own, rest = F.regexp_extract(col, "^[^?#]*", 0), F.regexp_extract(col, "[?#].*$", 0)
    return (
        F.when(col.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | col.startswith("_:"), col)
        .when(col.startswith("//"), F.concat(scheme, col))
        .when(col.startswith("/"), F.concat(scheme, host, without_dots(own), rest))
        .when(col.startswith("?"), F.concat(scheme, host, path, col))
        .when(col.startswith("#"), F.concat(scheme, host, path, query, col))
        .when(col == "", F.concat(scheme, host, path, query))
        .otherwise(F.concat(scheme, host, without_dots(F.concat(folder, own)), rest))
    )


def without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments: each ``..`` takes the segment before it, and a last one leaves its slash."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(done))
        .otherwise(F.concat(done, F.array(part))),
    )
    last = F.when(path.rlike(r"(^|/)\.\.?$"), "/").otherwise("")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), last)).otherwise(path)


def expand(df: DataFrame, col: str, prefixes: DataFrame, out: str = "iri") -> DataFrame:
    """Add ``out``: ``prefix:local`` as a full IRI by the table ``prefixes(prefix, iri)``.

    The prefix may be empty (``:luke``). ``<...>`` is taken as a full IRI. An unknown prefix gives NULL, so
    ``filter(out is null)`` counts the errors.
    """
    name = F.col(col)
    keyed = df.withColumn("_prefix", F.when(~name.startswith("<"), F.split_part(name, F.lit(":"), F.lit(1))))
    table = prefixes.select(F.col("prefix").alias("_prefix"), F.col("iri").alias("_iri"))
    joined = join_lookup(keyed, table, ["_prefix"], "left")
    local = F.substr(name, F.length("_prefix") + 2)
    iri = F.when(name.startswith("<"), F.regexp_extract(name, "^<(.*)>$", 1)).otherwise(F.concat(F.col("_iri"), local))
    return joined.select(*df.columns, iri.alias(out))


def compact(df: DataFrame, col: str, prefixes: DataFrame, out: str = "name") -> DataFrame:
    """Add ``out``: the IRI as ``prefix:local`` by its longest matching namespace, or ``<iri>`` when none matches.

    A row looks up its heads of all lengths that a namespace has; the lengths travel with the distinct IRIs as one small row.
    """
    iri = F.col(col)
    known = prefixes.groupBy("iri").agg(F.min("prefix").alias("prefix"))
    lengths = known.agg(F.collect_set(F.length("iri")).alias("_lengths")).withColumn("_one", F.lit(1))
    heads = (
        df.select(iri.alias("_full")).where(iri.isNotNull()).distinct().withColumn("_one", F.lit(1)).join(F.broadcast(lengths), ["_one"])
        .withColumn("_n", F.explode(F.filter("_lengths", lambda n: n <= F.length("_full"))))
        .select("_full", "_n", F.substring(F.col("_full"), F.lit(1), F.col("_n")).alias("iri"))
    )
    best = join_lookup(heads, known, ["iri"]).groupBy("_full").agg(F.max(F.struct("_n", "prefix")).alias("_best"))
    joined = df.join(best, iri == best["_full"], "left")
    name = F.concat(F.col("_best.prefix"), F.lit(":"), F.substr(iri, F.col("_best._n") + 1))
    return joined.select(*df.columns, F.when(F.col("_best").isNull(), F.concat(F.lit("<"), iri, F.lit(">"))).otherwise(name).alias(out))


def read_prefixes(text: DataFrame, col: str = "value") -> DataFrame:
    """Prefix declarations ``(prefix, iri)`` found in Turtle or RDF/XML text; the rest of the text is not read.

    Several declarations may stand on a line, XML values in either kind of quotes, and ``xmlns="..."`` declares the empty
    prefix. One row per prefix: within a text the last declaration wins, between texts the greatest IRI.
    """
    turtle = r"(?i)(?:^|[\s.])@?prefix\s+([^\s:<]*:\s*<[^<>\s]*>)"
    xml = r"""\bxmlns((?::[A-Za-z_][\w.-]*)?\s*=\s*(?:"[^"]*"|'[^']*'))"""
    found = F.concat(
        F.regexp_extract_all(F.col(col), F.lit(turtle), F.lit(1)), F.regexp_extract_all(F.col(col), F.lit(xml), F.lit(1))
    )
    one = text.select(F.posexplode(found).alias("at", "d"))
    is_xml = ~F.col("d").endswith(">")
    named = one.select(
        "at",
        F.when(is_xml, F.regexp_extract("d", r"^:?([^\s=]*)", 1)).otherwise(F.regexp_extract("d", r"^([^:]*):", 1)).alias("prefix"),
        F.when(is_xml, F.regexp_extract("d", r"""["'](.*)["']$""", 1)).otherwise(F.regexp_extract("d", r"<([^<>]*)>", 1)).alias("iri"),
    )
    return named.groupBy("prefix").agg(F.max(F.struct("at", "iri")).alias("last")).select("prefix", "last.iri")


def merge_prefixes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The prefix table after an import: an imported prefix replaces one of the same name."""
    return old.join(new, ["prefix"], "left_anti").select("prefix", "iri").unionByName(new.select("prefix", "iri"))
