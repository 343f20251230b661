"""Query of approximate nearest neighbours."""

from .common import column, table
from .neighbours import search
from .register import query


@query("op11_nearest_neighbours")
def op11_nearest_neighbours(spark, folder):
    """The twenty nearest of all vectors for every twentieth one."""
    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.where(column("vec_id") % 20 == 0))
