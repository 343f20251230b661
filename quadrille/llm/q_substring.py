"""Query of substring deduplication."""

from pyspark.sql import functions as F

from .common import WORD, table
from .register import query
from .substring_dedup import remove_repeats


@query("op10_substring_dedup", rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    places AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50),
    windows AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS said FROM places),
    hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY said) AS first FROM windows) WHERE first < doc_id),
    gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
      sha256(array_to_string(CASE WHEN ks IS NULL THEN words ELSE list_filter(words, lambda w, k: NOT list_contains(ks, k)) END, ' ')) AS kept_sha256
    FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id""")
def op10_substring_dedup(spark, folder):
    """Every document without the words of windows that an earlier document holds."""
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
