"""Query of language identification."""

from .common import column, table
from .langid import held_out, identify, learn
from .register import query


@query("op2_language_id")
def op2_language_id(spark, folder):
    """The language of every text, by profiles that have not seen the held-out quarter."""
    docs = table(spark, folder, "documents")
    return identify(docs, learn(docs.where(~held_out(column("doc_id")))))
