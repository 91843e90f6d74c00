import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def vocabularies():
    import public_tokenizers

    return {n: public_tokenizers.path(f"{n}_bpe_{k}k.json") for n, k in (("word", 49), ("byte", 50))}


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, odd characters."""
    rows = [
        (1, "the cat sat on the mat and the dog ran off", "en", "src0", 10),
        (1, "the cat sat on the mat and the dog ran off", "en", "src0", 10),
        (2, None, "en", "src0", None),
        (3, "", None, "src1", 0),
        (None, "a text that nobody gave an id", "en", None, 5),
        (None, None, None, None, None),
        (4, "  \n\t ", "fr", "src1", 5),
        (5, "chats et chiens éÉ ßẞ İI ŉ x́  y  ", "fr", "http://h.org/p/q", 5),
        (6, "x<|endoftext|>y <|startoftext|> z", "en", "src2", 3),
        (7, "long words " * 30_000, "en", "src0", 330_000),
        (8, "w" * 50_000, "de", "src0", 50_000),
        (9, "\x1c\x00 a\x00b  1 2 3 !!!", None, "src0", 3),
        (10, "the cat sat on the mat and the dog ran off", "en", "src0", 10),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture
def clashing(spark):
    """A frame's copy with more columns, named like those the operators use on their way."""

    def add(df):
        from pyspark.sql import functions as F

        names = [
            "fp", "key", "node", "to", "a", "b", "component", "count", "n", "length", "piece", "start", "ids", "shard",
            "block", "leaf", "far", "v", "score", "accepted", "quality", "site", "_logit", "turns", "rank", "vector",
            "copies", "least", "sha1", "first", "value", "level", "passage", "thread", "position", "group", "part",
        ]
        have = {c.lower() for c in df.columns}
        return df.withColumns({n: F.lit("x") for n in names if n.lower() not in have})

    return add
