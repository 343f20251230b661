"""Query of the n-gram Jaccard join."""

from .common import WORD, table
from .near_join import near_groups
from .register import query


@query("op5_ngram_jaccard_join", rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS words FROM documents),
    s AS (SELECT doc_id, unnest(list_distinct(CASE
        WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END)) AS gram FROM d),
    sets AS (SELECT doc_id, count(*) AS n, md5(array_to_string(list_sort(list(gram)), chr(10))) AS name FROM s GROUP BY doc_id),
    met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM met JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE shared / (x.n + y.n - shared) >= 0.8),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached(node, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT b, root FROM reached JOIN edges ON a = node AND root < b),
    classes AS (SELECT node, min(root) AS class_id FROM reached GROUP BY node)
    SELECT d.doc_id, class_id, (SELECT count(*) FROM edges WHERE a = d.doc_id) AS n_links,
      coalesce(min(d.doc_id) OVER (PARTITION BY coalesce(name, CAST(d.doc_id AS VARCHAR))), d.doc_id) AS copy_of
    FROM d JOIN classes ON node = d.doc_id LEFT JOIN sets ON sets.doc_id = d.doc_id""")
def op5_ngram_jaccard_join(spark, folder):
    """Every document with its class of near copies and its number of links."""
    return near_groups(table(spark, folder, "documents"))
