"""Column functions on RDF terms. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import NUMERIC_TYPES, XSD_BOOLEAN, XSD_DATE, XSD_DATETIME, XSD_STRING

# Characters that may not stand unescaped in the IRI of a line.
IRI_ESCAPED = '<>"{}|^`\\ '


def value_of(type_: Column, value: Column, datatype: Column, as_type: str) -> Column:
    """Native value of a term given by its parts; NULL where the term is no such value."""
    literal = type_ == "literal"
    if as_type in ("double", "long"):
        return F.when(literal & datatype.isin(NUMERIC_TYPES), value.try_cast(as_type))
    if as_type == "string":
        return F.when(literal & datatype.isin("", XSD_STRING), value)
    if as_type == "boolean":
        return F.when(
            literal & (datatype == XSD_BOOLEAN),
            F.when(value.isin("true", "1"), True).when(value.isin("false", "0"), False),
        )
    if as_type == "date":
        return F.when(literal & (datatype == XSD_DATE), value.try_cast("date"))
    if as_type == "timestamp":
        return F.when(literal & datatype.isin(XSD_DATETIME, XSD_DATE), value.try_cast("timestamp"))
    raise ValueError(f"no native type {as_type}")


def native(col: Column, as_type: str) -> Column:
    """Native value of a term column."""
    return value_of(col["type"], col["value"], col["datatype"], as_type)


def number(col: Column) -> Column:
    return native(col, "double")


def lexical(col: Column) -> Column:
    """STR(): the bare text of a term."""
    return col["value"]


def lang(col: Column) -> Column:
    """LANG(): language of a literal, '' when none; an error (NULL) on nodes."""
    return F.when(col["type"] == "literal", col["lang"])


def datatype(col: Column) -> Column:
    """DATATYPE(): xsd:string for plain literals; an error (NULL) on nodes."""
    return F.when(col["type"] == "literal", F.when(col["datatype"] == "", F.lit(XSD_STRING)).otherwise(col["datatype"]))


def decode_term(type_: Column, value: Column) -> Column:
    """Text form of a tagged result term: ``<iri>``, ``_:label`` or the literal; any other tag fails the job."""
    bare = F.regexp_replace(value, "^_:", "")
    return (
        F.when(type_ == "uri", F.concat(F.lit("<"), value, F.lit(">")))
        .when(type_ == "bnode", F.concat(F.lit("_:"), bare))
        .when(type_.isin("literal", "typed-literal"), value)
        .otherwise(F.raise_error(F.concat(F.lit("unknown term type: "), F.coalesce(type_, F.lit("null")))))
    )


def escape_text(col: Column) -> Column:
    """Escape a literal for one line of N-Triples."""
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        col = F.replace(col, F.lit(plain), F.lit(escaped))
    return col


def escape_iri(col: Column) -> Column:
    """Escape the characters an IRI may not hold; the backslash goes first, so later escapes stay as they are."""
    out = F.replace(col, F.lit("\\"), F.lit("\\u005C"))
    for ch in IRI_ESCAPED:
        if ch != "\\":
            out = F.replace(out, F.lit(ch), F.lit("\\u%04X" % ord(ch)))
    return F.when(col.rlike(r'[<>"{}|^`\\ ]'), out).otherwise(col)


def node_text(col: Column) -> Column:
    """N-Triples syntax of a node."""
    return F.when(col.startswith("_:"), col).otherwise(F.concat(F.lit("<"), escape_iri(col), F.lit(">")))


def term_text(type_: Column, value: Column, datatype_: Column, lang_: Column) -> Column:
    """N-Triples syntax of any term."""
    quoted = F.concat(F.lit('"'), escape_text(value), F.lit('"'))
    tail = (
        F.when(lang_ != "", F.concat(F.lit("@"), lang_))
        .when(datatype_ != "", F.concat(F.lit("^^<"), escape_iri(datatype_), F.lit(">")))
        .otherwise(F.lit(""))
    )
    return F.when(type_ == "literal", F.concat(quoted, tail)).otherwise(node_text(value))


# The one-letter escapes of the line grammar.
COMMON_ESCAPES = (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"))
RARE_ESCAPES = (("\\b", "\b"), ("\\f", "\f"), ("\\'", "'"))


def _replace_all(col: Column, pairs) -> Column:
    for escaped, plain in pairs:
        col = F.replace(col, F.lit(escaped), F.lit(plain))
    return col


def unescape(col: Column) -> Column:
    """Undo N-Triples escapes.

    Text without a backslash passes through, text with only the four common escapes takes plain replacements. The rest
    is cut at escaped backslashes, so that in every piece a backslash starts an escape of its own, and then before each
    numeric escape, so that a decoded character is never read as the start of another one.
    """

    def decode_part(x: Column) -> Column:
        def numeric(digits: int, charset: str) -> Column:
            char = F.decode(F.unhex(F.substring(x, 3, digits)), charset)
            return F.concat(char, _replace_all(F.substr(x, F.lit(3 + digits)), COMMON_ESCAPES + RARE_ESCAPES))

        return (
            F.when(x.startswith("\\U"), numeric(8, "UTF-32"))
            .when(x.startswith("\\u"), numeric(4, "UTF-16BE"))
            .otherwise(_replace_all(x, COMMON_ESCAPES + RARE_ESCAPES))
        )

    pieces = F.transform(F.split(col, r"\\\\"), lambda p: F.array_join(F.transform(F.split(p, r"(?=\\[uU])"), decode_part), ""))
    rare = col.rlike(r"\\[^nrt\"]")
    return F.when(F.instr(col, "\\") == 0, col).when(rare, F.array_join(pieces, "\\")).otherwise(_replace_all(col, COMMON_ESCAPES))


def sql_term(col: Column, data_type: T.DataType) -> tuple[Column, str]:
    """Lexical text and datatype of a relational column, as the natural mapping of SQL types gives them."""
    from ..model import XSD_DECIMAL, XSD_DOUBLE, XSD_INTEGER

    if isinstance(data_type, T.StringType):
        return col, ""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col.cast("string"), XSD_INTEGER
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return col.cast("string"), XSD_DOUBLE
    if isinstance(data_type, T.DecimalType):
        return col.cast("string"), XSD_DECIMAL
    if isinstance(data_type, T.BooleanType):
        return col.cast("string"), XSD_BOOLEAN
    if isinstance(data_type, T.DateType):
        return col.cast("string"), XSD_DATE
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return iso_datetime(col), XSD_DATETIME
    raise ValueError(f"no RDF datatype for column type {data_type.simpleString()}")


def iso_datetime(col: Column) -> Column:
    """ISO text of a timestamp in UTC, whatever the time zone of the session."""
    in_utc = F.to_utc_timestamp(col.cast("timestamp"), F.current_timezone())
    return F.concat(F.replace(in_utc.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
