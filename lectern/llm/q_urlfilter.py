"""Query of the url filters."""

from lectern.llm import urlfilter
from lectern.llm.registry import query

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]

LINK = urlfilter.LINKED_HOST.replace("'", "''")
LOWERED = f"translate(%s, '{urlfilter.UPPER}', '{urlfilter.LOWER}')"

SQL = rf"""
WITH RECURSIVE rules(verdict, rule, rule_host, rule_path) AS (VALUES {", ".join(
    f"('{verdict}', '{rule}', '{rule.split('/', 1)[0]}', '/{rule.split('/', 1)[1]}')" for verdict, rule in RULES)}
), u AS (
  SELECT page_id, html, row_number() OVER () AS row_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id, row_id, html, {LOWERED % "regexp_extract(rest, '^([^/?#]*)', 1)"} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), fits AS (
  SELECT row_id, rules.*, row_number() OVER (
           PARTITION BY row_id ORDER BY length(rule) DESC, length(rule_host) DESC, verdict DESC) AS place
  FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), ruled AS (
  SELECT p.*, rule, verdict FROM p LEFT JOIN fits ON p.row_id = fits.row_id AND place = 1
), seeds AS (
  SELECT unnest([CASE WHEN 2 * count(*) FILTER (verdict = 'allow') > count(*) THEN 'trust' END,
                 CASE WHEN 2 * count(*) FILTER (verdict = 'block') > count(*) THEN 'distrust' END]) AS way, host
  FROM ruled GROUP BY host
), edges AS (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT DISTINCT row_id, host AS src, unnest(list_transform(regexp_extract_all(html, '{LINK}', 1),
                                                              lambda x: {LOWERED % "x"})) AS dst FROM p
  ) WHERE src <> dst GROUP BY src, dst
), ways AS (
  SELECT 'trust' AS way, src, dst, weight FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges
), flow AS (  -- the node '/' holds the score of a seed and gives it to each seed in every round
  SELECT way, src, dst, CAST(weight * {urlfilter.DAMPING} AS HUGEINT) AS num,
         CAST(100 * sum(weight) OVER (PARTITION BY way, src) AS HUGEINT) AS den FROM ways
  UNION ALL SELECT way, '/', host, 1, 1 FROM seeds WHERE way IS NOT NULL
  UNION ALL SELECT DISTINCT way, '/', '/', 1, 1 FROM seeds WHERE way IS NOT NULL
), walk AS (
  SELECT DISTINCT 0 AS round, way, '/' AS host, CAST({urlfilter.UNIT} AS HUGEINT) AS score FROM seeds WHERE way IS NOT NULL
  UNION ALL
  SELECT round + 1, flow.way, dst, CAST(sum(score * num // den) AS HUGEINT)
  FROM walk JOIN flow ON walk.way = flow.way AND walk.host = flow.src
  WHERE round <= {urlfilter.ROUNDS} GROUP BY round, flow.way, dst
), scores AS (
  SELECT host, coalesce(max(score) FILTER (way = 'trust'), 0) AS trust,
         coalesce(max(score) FILTER (way = 'distrust'), 0) AS distrust
  FROM walk WHERE round = {urlfilter.ROUNDS} + 1 GROUP BY host
)
SELECT page_id, ruled.host, path, rule, coalesce(verdict, CASE WHEN distrust >= {urlfilter.LEAST}
         AND 100 * distrust > {urlfilter.MOST_DISTRUST} * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(coalesce(trust, 0) AS BIGINT) AS trust, CAST(coalesce(distrust, 0) AS BIGINT) AS distrust
FROM ruled LEFT JOIN scores ON ruled.host = scores.host
"""


@query("op11_link_trust_url_filter", SQL)
def op11_link_trust_url_filter(table):
    return urlfilter.judge(table("pages"), RULES)
