"""Query of exact deduplication."""

from .common import table
from .exact_dedup import LOWER, UPPER, exact_groups
from .register import query


@query("op3_exact_dedup", f"""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
    WINDOW same AS (PARTITION BY norm)""")
def op3_exact_dedup(spark, folder):
    """Groups of equal texts."""
    return exact_groups(table(spark, folder, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
