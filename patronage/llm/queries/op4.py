"""The ten best inner products of every hundredth embedding."""

from pyspark.sql import functions as F

from patronage.llm import topk
from patronage.llm.queries import table

NAME = "op4_exact_topk"
SQL = """
WITH whole AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def query(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)
