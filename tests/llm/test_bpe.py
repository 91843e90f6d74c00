import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from patronage.llm import bpe


@pytest.fixture(scope="module")
def library(vocabularies):
    return Tokenizer.from_file(vocabularies["byte"])


def test_odd_documents(spark, odd_docs, clashing, vocabularies, library):
    docs = clashing(odd_docs).drop("ids")
    out = bpe.decode(bpe.encode(docs, vocabularies["byte"]), vocabularies["byte"])
    assert out.columns == [*docs.columns, "ids", "decoded"]
    for r in out.collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False) == (r["text"] or "")


def test_digests(spark, sf_dir, vocabularies, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = vocabularies["byte"]
    out = {r["doc_id"]: r for r in bpe.digests(bpe.decode(bpe.encode(docs, path), path)).collect()}
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert out[r["doc_id"]]["n_tokens"] == len(ids)
        assert out[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert out[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_empty_table(spark, odd_docs, vocabularies):
    path = vocabularies["byte"]
    assert bpe.digests(bpe.decode(bpe.encode(odd_docs.limit(0), path), path)).count() == 0


def test_ids_that_are_no_text(spark, vocabularies):
    rows = spark.createDataFrame([(1, [50256, 447]), (2, []), (3, None)], "doc_id long, ids array<int>")
    out = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, vocabularies["byte"]).collect()}
    want = Tokenizer.from_file(vocabularies["byte"]).decode([50256, 447], skip_special_tokens=False)
    assert out == {1: want, 2: "", 3: ""}


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text(" 'aeinrst\n.", max_size=60))
def test_any_text(text):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    global _library
    if "_library" not in globals():
        _library = Tokenizer.from_file(path)
    flat, sizes = bpe.byte_cache(path).ids(pa.array([text]))
    assert flat.tolist() == _library.encode(text, add_special_tokens=False).ids and sizes.tolist() == [len(flat)]


def test_emptied_trie_gives_the_same(vocabularies, monkeypatch, library):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abehinorst"), rng.integers(1, 12))) for _ in range(500)]
    monkeypatch.setattr(bpe, "MOST_PAIRS", 5)
    found = bpe.Trie(bpe.Vocabulary(vocabularies["byte"])).encode([w.encode() for w in words])
    assert all(found[w.encode()] == library.encode(w, add_special_tokens=False).ids for w in words)
