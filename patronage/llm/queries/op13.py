"""Lines that at least five documents share, dropped from all but the last of them."""

from pyspark.sql import functions as F

from patronage.llm import line_dedup
from patronage.llm.queries import table

NAME = "op13_line_dedup"
SQL = """
WITH cut AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM cut),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
repeated AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
    SELECT k.doc_id, k.line, k.i, keeper IS NOT NULL AND keeper IS DISTINCT FROM k.doc_id AS goes
    FROM keyed k LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT goes), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def query(spark, sf_dir):
    found = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
