"""N-Triples and N-Quads text to quads.

A line is cut into its terms by one pass of one expression; escapes are decoded only in terms that hold a backslash.
Compressed files (gz, bz2) are read by the file system codecs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import unescape
from ..model import DEFAULT_GRAPH, QUAD, XSD_STRING

# The terms of the line grammar. Loops are possessive, so long literals need no deep matching stack.
ESCAPE = r"\\(?:[tbnrf\"'\\]|u(?![Dd][89A-Fa-f])[0-9A-Fa-f]{4}|U(?!0000[Dd][89A-Fa-f])00(?:0[0-9A-Fa-f]|10)[0-9A-Fa-f]{4})"
IRI = r"<(?:[^\x00-\x20<>\"{}|^`\\]|\\u(?![Dd][89A-Fa-f])[0-9A-Fa-f]{4}|\\U(?!0000[Dd][89A-Fa-f])00(?:0[0-9A-Fa-f]|10)[0-9A-Fa-f]{4})*+>"
BNODE = r"_:[\p{L}\p{N}_](?:[\p{L}\p{N}_.\-\u00B7]*[\p{L}\p{N}_\-\u00B7])?"
TEXT = r"\"(?:[^\"\\\n\r]++|" + ESCAPE + r")*+\""
LITERAL = TEXT + r"(?:\^\^" + IRI + r"|@[A-Za-z]+(?:-[A-Za-z0-9]+)*+)?"
SPACE = r"[ \t]*+"
STATEMENT = (
    f"(?s)^{SPACE}({IRI}|{BNODE}){SPACE}({IRI}){SPACE}({IRI}|{BNODE}|{LITERAL}){SPACE}({IRI}|{BNODE})?{SPACE}\\.{SPACE}(?:#.*)?\\z"
)
TERM = f"{LITERAL}|{IRI}|{BNODE}"
BLANK = r"(?s)^[ \t]*(?:#.*)?\z"


def _bare(token: Column) -> Column:
    """IRI without brackets; anything else as written."""
    return F.when(token.startswith("<"), F.substr(token, F.lit(2), F.length(token) - 2)).otherwise(token)


def parse_lines(lines: DataFrame, graph: str = DEFAULT_GRAPH) -> tuple[DataFrame, DataFrame]:
    """Quads of the valid lines, and the lines (``value``) that are no statement. Both are lazy.

    Statements without a graph go to ``graph``. Repeated lines stay repeated; ``as_set`` merges them.
    """
    checked = lines.select("value", F.col("value").rlike(STATEMENT).alias("_ok"))
    bad = checked.filter(~F.col("_ok") & ~F.col("value").rlike(BLANK)).select("value")
    tokens = F.regexp_extract_all(F.col("value"), F.lit(f"({TERM})"), F.lit(1))
    # A comment after the final dot may hold term-like text; only lines that can have one look for the graph again.
    may_comment = F.col("value").rlike(r"\.[ \t]*#")
    fourth = F.when(may_comment, F.regexp_extract("value", STATEMENT, 4)).otherwise(F.get(tokens, F.lit(3)))
    # Each step names its results, so that no later step works them out again for every use.
    cut = checked.filter("_ok").select(tokens.alias("t"), fourth.alias("g"))
    terms = cut.select(F.get("t", F.lit(0)).alias("s"), F.get("t", F.lit(1)).alias("p"), F.get("t", F.lit(2)).alias("o"), "g")
    literal = F.col("o").startswith('"')
    # The last quote of a literal ends its text: neither a datatype IRI nor a language tag holds one.
    tail = F.when(literal, F.substring_index("o", '"', -1)).otherwise("")
    tailed = terms.select("s", "p", "o", "g", literal.alias("literal"), tail.alias("tail"))
    size = F.length("o") - F.length("tail") - 2
    # Text of a literal, IRI without brackets, or blank node as written.
    inner = F.when(F.col("literal"), F.substr("o", F.lit(2), size)).otherwise(_bare(F.col("o")))
    kind = F.when(F.col("literal"), "literal").when(F.col("o").startswith("<"), "uri").otherwise("bnode")
    datatype = F.when(F.col("tail").startswith("^^"), _bare(F.substr("tail", F.lit(3)))).otherwise("")
    language = F.when(F.col("tail").startswith("@"), F.substr("tail", F.lit(2))).otherwise("")
    named = tailed.select(
        _bare(F.col("s")).alias("s"), _bare(F.col("p")).alias("p"), inner.alias("o_value"), kind.alias("o_type"),
        datatype.alias("o_datatype"), language.alias("o_lang"), _bare(F.col("g")).alias("g"),
    )
    plain = {c: unescape(F.col(c)) for c in ("s", "p", "o_value", "o_datatype", "g")}
    plain["o_datatype"] = F.when(plain["o_datatype"] == XSD_STRING, "").otherwise(plain["o_datatype"])
    plain["g"] = F.when(F.coalesce(F.col("g"), F.lit("")) == "", F.lit(graph)).otherwise(plain["g"])
    quads = named.select(*[plain.get(c, F.col(c)).alias(c) for c in QUAD])
    return quads, bad


def read_nquads(spark: SparkSession, paths: str | list[str], graph: str = DEFAULT_GRAPH, skip_bad_lines: bool = False) -> DataFrame:
    """Quads of N-Triples or N-Quads files.

    A line that is no statement, comment or blank makes the job fail with its text; with ``skip_bad_lines`` such lines are left
    to :func:`read_corrupt`.
    """
    lines = spark.read.text(paths)
    if not skip_bad_lines:
        line = F.col("value")
        wrong = F.raise_error(F.concat(F.lit("no statement: "), line)).cast("boolean")
        lines = lines.filter(F.when(line.rlike(STATEMENT), F.lit(True)).when(line.rlike(BLANK), F.lit(False)).otherwise(wrong))
    return parse_lines(lines, graph)[0]


def read_corrupt(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines that are no statement, for a side output."""
    return parse_lines(spark.read.text(paths))[1]
