"""Quality of every document by its text and its site."""

from pyspark.sql import functions as F

from patronage.llm import quality
from patronage.llm.langid import held_out
from patronage.llm.queries import table

NAME = "op3_quality_classifier"
SQL = None  # a fitted model; tests/llm/test_quality.py checks it


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = quality.score(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "quality", "text_score", "site", "accepted")
