"""Query of phrase mining."""

from lectern.llm.phrases import COVERED, LEAST, SCALE, TOP, collocations
from lectern.llm.registry import query

SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), p AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d
), f1 AS (
  SELECT lang, a, count(*) AS f FROM (SELECT lang, unnest(w) AS a FROM p) GROUP BY lang, a
), f2 AS (
  SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM p) GROUP BY ALL HAVING count(*) >= {LEAST}
), f3 AS (
  SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM p) GROUP BY ALL HAVING count(*) >= {LEAST}
), covered AS (
  SELECT lang, a, b, max(f) AS longer
  FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY lang, a, b
), cuts AS (
  SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, 1 AS k, f2.f AS a, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON f2.lang = x.lang AND f2.a = x.a JOIN f1 y ON f2.lang = y.lang AND f2.b = y.a
  LEFT JOIN covered ON f2.lang = covered.lang AND f2.a = covered.a AND f2.b = covered.b
  WHERE longer IS NULL OR 100 * longer < {COVERED} * f2.f
  UNION ALL
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, 1, f3.f, x.f, y.f
  FROM f3 JOIN f1 x ON f3.lang = x.lang AND f3.a = x.a
  JOIN f2 y ON f3.lang = y.lang AND f3.b = y.a AND f3.c = y.b
  UNION ALL
  SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, 2, f3.f, x.f, y.f
  FROM f3 JOIN f2 x ON f3.lang = x.lang AND f3.a = x.a AND f3.b = x.b
  JOIN f1 y ON f3.lang = y.lang AND f3.c = y.a
), s AS (
  SELECT *, CAST((CAST({SCALE} AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
), lowest AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= {TOP}
"""


@query("op13_trie_collocations", SQL)
def op13_trie_collocations(table):
    return collocations(table("documents"))
