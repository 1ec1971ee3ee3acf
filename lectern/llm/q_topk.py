"""Query of exact top-k search."""

from pyspark.sql import functions as F

from lectern.llm.registry import query
from lectern.llm.topk import top_k

SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 10
"""


@query("op8_voronoi_topk", SQL)
def op8_voronoi_topk(table):
    return top_k(table("embeddings"), F.col("vec_id") % 100 == 0)
