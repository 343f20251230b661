"""Query of embedding whitening."""

from .common import table
from .register import query
from .whitening import whiten


@query("op13_whitening")
def op13_whitening(spark, folder):
    """Sixteen whitened components of every embedding."""
    return whiten(table(spark, folder, "embeddings"))
