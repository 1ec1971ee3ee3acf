"""Query of mixing sources to target weights."""

from lectern.llm.mixing import mix
from lectern.llm.registry import query

# the same draw in SQL: targets by rising limit per weight, copies by falling weight, one ranking per source
SQL = r"""
WITH d AS (
  SELECT doc_id, source, size, CAST(length(bin(size)) AS BIGINT) AS weight,
         (CAST(('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)::DOUBLE + 0.5)
           / 4503599627370496.0 AS u
  FROM (SELECT doc_id, source, coalesce(CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT), 0) AS size
        FROM documents)
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source
), t1 AS (
  SELECT *, sum(source_size) OVER () AS everything,
         coalesce(sum(source_size) OVER (ORDER BY 3.0 * source_size / w, encode(source) NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 3 AS limited,
         sum(w) OVER (ORDER BY 3.0 * source_size / w, encode(source) NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM s
), t2 AS (
  SELECT *, min(CASE WHEN CAST(everything - limited AS DOUBLE) * w / open <= 3 * source_size THEN limited END)
              OVER () AS stop FROM t1
), t3 AS (
  SELECT *, first_value(CASE WHEN stop IS NULL THEN NULL ELSE everything - stop END) OVER () AS words,
         (SELECT max(open) FROM t2 WHERE limited = stop) AS weights FROM t2
), t AS (
  SELECT source, source_size,
         CASE WHEN stop IS NULL THEN CAST(3 * source_size AS DOUBLE)
              ELSE least(CAST(words AS DOUBLE) * w / weights, CAST(3 * source_size AS DOUBLE)) END AS target
  FROM t3
), l1 AS (
  SELECT d.source, weight, CAST(sum(size) AS BIGINT) AS words, any_value(t.source_size) AS source_size,
         any_value(t.target) AS target
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.source, weight
), l2 AS (
  SELECT *, (target - 3 * coalesce(sum(words) OVER (PARTITION BY source ORDER BY weight DESC
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / nullif(sum(words * weight) OVER (PARTITION BY source ORDER BY weight DESC
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS factor
  FROM l1
), l3 AS (
  SELECT *, max(CASE WHEN factor * weight <= 3 THEN factor END) OVER (PARTITION BY source) AS f FROM l2
), l AS (
  SELECT source, weight, words, source_size, target,
         CASE WHEN source_size = 0 THEN 0.0 ELSE least(coalesce(f * weight, 3.0), 3.0) END AS expected
  FROM l3
), c AS (
  SELECT source, sum(floor(expected) * words) AS certain FROM l GROUP BY source
), r AS (
  SELECT d.doc_id, d.source, d.size, l.source_size, l.target, l.expected, l.target - c.certain AS missing,
         CASE WHEN l.expected > floor(l.expected) THEN
           (u / (1 - u)) / ((l.expected - floor(l.expected)) / (1 - (l.expected - floor(l.expected)))) END AS rank
  FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source AND d.weight = l.weight
         JOIN c ON d.source IS NOT DISTINCT FROM c.source
), k AS (
  SELECT *, CASE WHEN rank IS NOT NULL AND size > 0 THEN
         coalesce(sum(CASE WHEN rank IS NOT NULL AND size > 0 THEN size END) OVER (
           PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS before FROM r
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(expected) + CASE WHEN before + size / 2 < missing THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k
"""


@query("op3_pareto_mixing", SQL)
def op3_pareto_mixing(table):
    return mix(table("documents")).select("doc_id", "size", "source_size", "target", "taken")
