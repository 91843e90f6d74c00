import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm import packing


def token_ids(path, text, end):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end]


def check(rows, docs, path, capacity):
    """Every piece is right and every sequence gapless."""
    want = []
    for doc_id, text in docs:
        ids = token_ids(path, text, 0)
        for i in range(0, len(ids), capacity):
            part = ids[i : i + capacity]
            want.append((doc_id, i // capacity, i, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([tuple(r[:5]) for r in rows], key=key) == sorted(want, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [2048, 16])
def test_odd_documents(spark, odd_docs, clashing, vocabularies, capacity):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows = packing.pack_documents(clashing(odd_docs), vocabularies["word"], 0, capacity).collect()
    check(rows, docs, vocabularies["word"], capacity)


def test_empty_table(spark, odd_docs, vocabularies):
    out = packing.pack_documents(odd_docs.limit(0), vocabularies["word"])
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "piece"]


def test_corpus_meets_its_bound(spark, sf_dir, vocabularies):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack_documents(docs, vocabularies["word"]).collect()
    used = check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], vocabularies["word"], 2048)
    counts = np.bincount([r["length"] for r in rows], minlength=2049)
    assert packing.lower_bound(counts, 2048) <= used <= packing.lower_bound(counts, 2048) + 1


def test_exchange_between_groups_saves_sequences(spark):
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 60, 3000).tolist()
    items = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECES)
    used = packing.pack(items, 100, group_items=100).select("sequence_id").distinct().count()
    alone = sum(
        len(packing.best_fit_decreasing(np.array(lengths[i : i + 100]), 100)[2]) for i in range(0, 3000, 100)
    )
    bound = packing.lower_bound(np.bincount(lengths, minlength=101), 100)
    assert bound <= used <= bound + 3 and used < alone


def test_bounds_hold_against_the_best_packing():
    rng = np.random.default_rng(1)

    def best(sizes, capacity):
        """Fewest sequences, by trying all places."""

        def go(i, rooms):
            if i == len(sizes):
                return len(rooms)
            found = go(i + 1, [*rooms, capacity - sizes[i]])
            for j in {r: j for j, r in enumerate(rooms) if r >= sizes[i]}.values():
                found = min(found, go(i + 1, [r - sizes[i] if k == j else r for k, r in enumerate(rooms)]))
            return found

        return go(0, [])

    for _ in range(40):
        sizes = sorted(rng.integers(1, 11, 7).tolist(), reverse=True)
        fewest = best(sizes, 10)
        assert packing.lower_bound(np.bincount(sizes, minlength=11), 10) <= fewest
        assert len(packing.best_fit_decreasing(np.array(sizes), 10)[2]) >= fewest
    # six of 6, which no two share, need six sequences though their sum needs four
    assert packing.lower_bound(np.bincount([6] * 6, minlength=11), 10) == 6


def test_full_pieces_have_sequences_of_their_own(spark):
    items = spark.createDataFrame([(1, i, i * 4, 4, 0) for i in range(5)] + [(2, 0, 0, 1, 0)], packing.PIECES)
    out = packing.pack(items, 4)
    assert out.select("sequence_id").distinct().count() == 6
    assert out.where(F.col("offset") != 0).count() == 0
