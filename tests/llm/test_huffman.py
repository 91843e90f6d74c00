import heapq
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm import huffman
from patronage.session import scratch_path


def huffman_cost(counts):
    heap, cost = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("n", [2, 3, 17, 600])
def test_lengths_are_optimal_and_limited(n):
    counts = np.random.default_rng(n).zipf(1.4, n).clip(1, 10**6)
    free = huffman.code_lengths(counts, 40)
    assert (free * counts).sum() == huffman_cost(counts)
    tight = max(int(np.ceil(np.log2(n))), 1)
    for most in (tight, tight + 2):
        short = huffman.code_lengths(counts, most)
        assert short.max() <= most and (0.5**short).sum() <= 1 + 1e-12
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)


def test_round_trip_of_arrays():
    rng = np.random.default_rng(0)
    flat = rng.zipf(1.3, 20_000).clip(1, 900).astype(np.int32)
    sizes = np.array([0, 1, 7000, 128, 129, 12_742, 0])
    ids, counts = np.unique(flat, return_counts=True)
    bits = huffman.code_lengths(counts, 12)
    code, length = huffman.canonical(ids, bits)
    payload, begin, size, inside = huffman.encode_ids(flat, sizes, code, length)
    table, lengths, width = huffman.lookup(ids, bits)
    for k, n in enumerate(sizes.tolist()):
        at = int(sizes[:k].sum())
        part = payload[begin[k] : begin[k] + size[k]]
        out = huffman.decode_payload(part, np.zeros(min(n, 1), np.int64), np.array([n] * min(n, 1)), table, lengths, width)
        assert out.tolist() == flat[at : at + n].tolist()
        for i in range(0, n, 999):  # any id's offset is a place to start
            one = huffman.decode_payload(part, inside[at + i : at + i + 1], np.array([1]), table, lengths, width)
            assert one.tolist() == [flat[at + i]]


def want(rows, path):
    library, start, out = Tokenizer.from_file(path), 0, []
    coded = [(doc_id, library.encode(text or "", add_special_tokens=False).ids + [1]) for doc_id, text in rows]
    for doc_id, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0)):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_odd_documents(spark, odd_docs, clashing, vocabularies, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_BYTES", 100)
    path = scratch_path(spark, "test")
    huffman.write(clashing(odd_docs), path, vocabularies["word"], 1, shard_ids=20_000)
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in huffman.read_digests(spark, path).collect()), key=lambda r: r[1])
    expected = want(docs, vocabularies["word"])
    # rows without a doc_id, or with the same one, may stand in any order among themselves
    starts = lambda rows: [r[1] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    assert [r[0] for r in found] == [r[0] for r in expected]
    assert sorted((r[0] or 0, r[2], r[3]) for r in found) == sorted((r[0] or 0, r[2], r[3]) for r in expected)
    assert starts(found)[2:] == starts(expected)[2:]
    library = Tokenizer.from_file(vocabularies["word"])
    ids = {(r["doc_id"], tuple(r["ids"])) for r in huffman.read_ids(spark, path).collect()}
    assert ids == {(d, (*library.encode(t or "", add_special_tokens=False).ids, 1)) for d, t in docs}


def test_corpus(spark, sf_dir, vocabularies):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = scratch_path(spark, "test")
    huffman.write(docs.repartition(5), path, vocabularies["word"], 1)
    found = sorted(tuple(r) for r in huffman.read_digests(spark, path).collect())
    assert found == want([tuple(r) for r in docs.collect()], vocabularies["word"])
    bits = 8 * spark.read.parquet(f"{path}/blocks").select(F.sum(F.length("payload"))).first()[0]
    assert bits < 14 * sum(r[2] for r in found)


def test_empty_table(spark, odd_docs, vocabularies):
    path = scratch_path(spark, "test")
    huffman.write(odd_docs.limit(0), path, vocabularies["word"], 1)
    assert huffman.read_digests(spark, path).count() == 0 and huffman.read_ids(spark, path).count() == 0
