"""Codes of all embeddings in 16 parts of 64 entries, two rounds."""

from patronage.llm import vector_codes
from patronage.llm.queries import table

NAME = "op12_vector_codes"


def _round(given: str, moved: str, assigned: str) -> str:
    """Parts with their nearest entry, and the entries moved to the means of their parts."""
    return f"""
{assigned} AS MATERIALIZED (
    SELECT vec_id, label, p, v, min(struct_pack(d := list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(v, e)]),
        entry := entry)) AS near
    FROM part JOIN {given} USING (p) GROUP BY vec_id, label, p, v),
{moved} AS MATERIALIZED (
    SELECT p, entry, coalesce(m, e) AS e FROM {given} LEFT JOIN (
        SELECT p, entry, list(x ORDER BY i) AS m FROM (
            SELECT p, near.entry AS entry, i, floor(sum(x) / count(*))::BIGINT AS x
            FROM (SELECT p, near, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM {assigned})
            GROUP BY 1, 2, 3)
        GROUP BY p, entry) USING (p, entry)),"""


SQL = f"""
WITH kept AS (
    SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
part AS MATERIALIZED (
    SELECT vec_id, label, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS v
    FROM kept, (SELECT unnest(range(16)) AS p)),
book0 AS MATERIALIZED (
    SELECT p, entry, v AS e FROM part JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)),
{_round("book0", "book1", "round1")}
{_round("book1", "book2", "round2")}
final AS (
    SELECT vec_id, label, p, min(struct_pack(d := list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(v, e)]),
        entry := entry)) AS near
    FROM part JOIN book2 USING (p) GROUP BY vec_id, label, p),
coded AS (
    SELECT vec_id, label, string_agg(lower(printf('%02x', near.entry)), '' ORDER BY p) AS code,
        sum(near.d)::BIGINT AS error
    FROM final GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, entry)) FROM book2) AS codebooks_sha256
FROM coded
"""


def query(spark, sf_dir):
    return vector_codes.digests(*vector_codes.compress(table(spark, sf_dir, "embeddings")))
