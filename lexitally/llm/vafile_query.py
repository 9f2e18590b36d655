"""op1: exact top-k search over all embeddings."""

from pyspark.sql import functions as F

from lexitally.llm.registry import query
from lexitally.llm.vafile import top_k
from lexitally.sources.io import read_table

SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


@query("op1_vafile_top_k", SQL)
def op1(spark, sf):
    found = top_k(read_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
