"""Training data out of `documents`: four stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.llm import langid, packing, quality, simhash
from patronage.llm.queries import table, vocabulary
from patronage.session import cut_lineage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; models are fitted on the stage's own input."""
    return langid.accepted(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of accepted quality, by the labels of those that are left."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=0)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Fitted models, hashes and token ids can't be had in SQL; tests/llm/test_pipeline.py checks run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
