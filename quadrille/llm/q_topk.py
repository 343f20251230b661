"""Query of exact top-k search."""

from .common import column, table
from .register import query
from .topk import search


@query("op4_topk_search", """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10""")
def op4_topk_search(spark, folder):
    """The ten best of all vectors for every hundredth one."""
    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.where(column("vec_id") % 100 == 0))
