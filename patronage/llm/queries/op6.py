"""Ids of all documents, written in Huffman coded files and read back."""

from patronage.llm import huffman
from patronage.llm.queries import table, vocabulary
from patronage.session import scratch_path

NAME = "op6_token_output"
SQL = None  # tokenises; tests/llm/test_huffman.py checks it


def query(spark, sf_dir):
    path = scratch_path(spark, "ids")
    huffman.write(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return huffman.read_digests(spark, path)
