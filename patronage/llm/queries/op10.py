"""Links and groups of all embeddings by cosine."""

from patronage.llm import embedding_dedup
from patronage.llm.queries import table

NAME = "op10_embedding_near_dedup"
SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in embedding if x <> 0]) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE list_inner_product(a.v, b.v)
        / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.95),
reach AS (
    SELECT vec_id AS node, vec_id AS other FROM embeddings
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON node = e.vec_id LEFT JOIN counts ON a = e.vec_id
"""


def query(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
