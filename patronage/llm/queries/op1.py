"""All documents in sequences of at most 2048 tokens."""

from patronage.llm import packing
from patronage.llm.queries import table, vocabulary

NAME = "op1_best_fit_packing"
SQL = None  # tokenises; tests/llm/test_packing.py checks it


def query(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=0)
