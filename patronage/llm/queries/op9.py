"""SimHash fingerprints and near-duplicate groups of all documents."""

from patronage.llm import simhash
from patronage.llm.queries import table

NAME = "op9_simhash_near_dedup"
SQL = None  # hashes; tests/llm/test_simhash.py checks it


def query(spark, sf_dir):
    return simhash.digests(simhash.near_duplicates(table(spark, sf_dir, "documents")))
