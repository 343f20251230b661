"""Queries of token counts and of encoding."""

from .common import table
from .register import query
from .tokens import encode_digests, length_histogram, token_counts


@query("op1_token_counts")
def op1_token_counts(spark, folder):
    """The exact histogram of encoded lengths, with suffix sums."""
    return length_histogram(token_counts(table(spark, folder, "documents")))


@query("op6_byte_bpe")
def op6_byte_bpe(spark, folder):
    """Every whole text encoded and decoded."""
    return encode_digests(table(spark, folder, "documents"))
