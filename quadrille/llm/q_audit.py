"""Query of the filter interaction audit."""

from .common import WORD, table
from .filter_audit import audit
from .register import query


@query("op12_filter_audit", rf"""
    WITH d AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
    f AS (
      SELECT doc_id, part,
        CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
          + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body) THEN 4 ELSE 0 END
          + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
          + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END AS bits FROM d),
    l AS (
      SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
    c AS (
      SELECT part, bits, count(*) AS docs, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, bits),
    letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
    orders AS (
      SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bit
      FROM letter a, letter b, letter c, letter d, letter e
      WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
    steps AS (
      SELECT filter_order, step, bit[step] AS own, CAST(coalesce(list_sum(bit[1:step - 1]), 0) AS INTEGER) AS earlier
      FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
    found AS (
      SELECT part, filter_order, step, own,
        sum(CASE WHEN bits & (own | earlier) = 0 THEN docs ELSE 0 END) AS kept, sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN docs ELSE 0 END) AS removed,
        sum(CASE WHEN bits & earlier <> 0 AND bits & own <> 0 THEN docs ELSE 0 END) AS redundant, sum(CASE WHEN bits = own THEN docs ELSE 0 END) AS unique_fails,
        sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, steps GROUP BY part, filter_order, step, own)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
      CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
      CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
    FROM found""")
def op12_filter_audit(spark, folder):
    """Five filters in all orders over all documents."""
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
