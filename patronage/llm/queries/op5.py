"""Byte-level ids of all documents, and the texts they decode to."""

from patronage.llm import bpe
from patronage.llm.queries import table, vocabulary

NAME = "op5_bpe"
SQL = None  # tokenises; tests/llm/test_bpe.py checks it


def query(spark, sf_dir):
    path = vocabulary("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.decode(bpe.encode(docs, path).select("doc_id", "ids"), path))
