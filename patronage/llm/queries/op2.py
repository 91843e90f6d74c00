"""Language of every document."""

from pyspark.sql import functions as F

from patronage.llm import langid
from patronage.llm.queries import table

NAME = "op2_language_id"
SQL = None  # a fitted model; tests/llm/test_langid.py checks it


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
