"""Query of mixing."""

from .common import WORD, table
from .mixing import SEED, mix, quality_weights
from .register import query


@query("op8_mixing", rf"""
    WITH sized AS (
      SELECT d.doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
        -ln((CAST('0x' || substr(sha256('{SEED}' || d.doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
          / CASE coalesce(quality, -1) WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
      FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id),
    per AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
      FROM sized GROUP BY source),
    levels AS (
      SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM per),
    targets AS (SELECT source, source_size, CAST(least(2.0 * source_size, weight * max(level) OVER ()) AS DOUBLE) AS target FROM levels),
    summed AS (
      SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
        sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, round(target, 3) AS target,
      CAST(size * (epochs + CASE WHEN epochs < 2 AND upto - size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM summed""")
def op8_mixing(spark, folder):
    """The mix of all documents; targets to three decimals."""
    from pyspark.sql import functions as F

    plan = mix(table(spark, folder, "documents"), quality=quality_weights(table(spark, folder, "labels")))
    return plan.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")
