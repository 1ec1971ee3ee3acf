"""Queries of line-wise removal."""

from lectern.llm import lineedit
from lectern.llm.linehash import dedup
from lectern.llm.registry import query

SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, substr(sha256(coalesce(text, '')), 1, 32) AS key,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), u AS (
  SELECT doc_id, key, unnest(lines) AS line, unnest(range(len(lines))) AS unit,
         unnest(list_transform(range(len(lines)),
           lambda i: i + coalesce(list_sum(list_transform(lines[1:i], lambda x: length(x))), 0))) AS start
  FROM (SELECT DISTINCT * FROM d)
), n AS (
  SELECT *, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS normal
  FROM u
), r AS (
  SELECT *, len(regexp_extract_all(normal, '[^ ]+')) >= 1 AND row_number() OVER (
           PARTITION BY normal ORDER BY doc_id NULLS LAST, key, unit) > 1 AS gone
  FROM n
), k AS (
  SELECT doc_id, key, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(CASE WHEN gone THEN CAST(CAST(start AS BIGINT) AS VARCHAR) || ':'
                    || CAST(CAST(start AS BIGINT) + length(line) AS VARCHAR) END, ',' ORDER BY unit), '') AS removed,
         sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY unit), '')) AS kept_sha256
  FROM r GROUP BY doc_id, key
)
SELECT d.doc_id, n_removed, n_units, removed, kept_sha256
FROM d JOIN k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.key = k.key
"""


@query("op5_line_hash_dedup", SQL)
def op5_line_hash_dedup(table):
    return dedup(table("documents"))


@query("op6_line_edit_dedup")
def op6_line_edit_dedup(table):
    return lineedit.dedup(table("documents"), least=1)
