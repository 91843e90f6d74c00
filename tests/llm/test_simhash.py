import brute
import numpy as np
import pytest

from patronage.llm import components, simhash


def expected(rows, bits=2):
    """(doc_id, fingerprint, component) by comparing all pairs."""
    fps = [brute.simhash(t) for _, t in rows]
    least = {}
    for (d, _), f in zip(rows, fps):
        least[f] = min((x for x in (least.get(f), d) if x is not None), default=None)
    kinds = list(least)
    pairs = [(x, y) for x in kinds for y in kinds if x < y and (x ^ y).bit_count() <= bits]
    group = brute.groups(kinds, pairs)
    named = {}
    for f in kinds:
        named.setdefault(group[f], []).append(least[f])
    smallest = {g: min((x for x in ids if x is not None), default=None) for g, ids in named.items()}
    return sorted(((d, f"{f:016x}", smallest[group[f]]) for (d, _), f in zip(rows, fps)), key=repr)


def test_odd_documents(spark, odd_docs, clashing):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    found = simhash.digests(simhash.near_duplicates(clashing(odd_docs)))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = simhash.digests(simhash.near_duplicates(docs))
    assert sorted(map(tuple, found.collect()), key=repr) == expected([tuple(r) for r in docs.collect()])


def test_empty_table(spark, odd_docs):
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0
    assert simhash.one_of_each(odd_docs.limit(0)).columns == odd_docs.columns


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("most_bucket", [2, 4096])
def test_links_of_crowded_fingerprints(spark, bits, most_bucket):
    rng = np.random.default_rng(bits)
    fps = set()
    for centre in rng.integers(0, 2**63, 4).tolist():
        for _ in range(150):
            fps.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)))
    fps = sorted(f - 2**64 if f >= 2**63 else f for f in fps)
    pairs = [(x, y) for x in fps for y in fps if x < y and ((x ^ y) % 2**64).bit_count() <= bits]
    found = components.components(
        simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), bits, most_bucket)
    )
    of = {r["node"]: r["component"] for r in found.collect()}
    assert {f: of.get(f, f) for f in fps} == brute.groups(fps, pairs)


def test_one_of_each(spark, odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    keep = {d for d, _, c in expected(rows) if d is not None and d == c}
    out = simhash.one_of_each(odd_docs)
    assert out.columns == odd_docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    # of the two rows without an id one has no words, like documents that have one
    assert sorted(i for i in ids if i is not None) == sorted(keep) and ids.count(None) == 1


def test_copies_without_an_id(spark):
    text = "one two three four five"
    rows = [(None, text, 1), (None, text, 2), (None, "six seven eight", 3), (4, "six seven eight", 4), (None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, number int").repartition(4)
    out = [tuple(r) for r in simhash.one_of_each(docs).collect()]
    assert sorted((i or 0, t or "") for i, t, _ in out) == [(0, ""), (0, text), (4, "six seven eight")]


def test_components_of_long_chains_and_stars(spark):
    n = 300
    rng = np.random.default_rng(0)
    order = rng.permutation(n).tolist()
    links = list(zip(order, order[1:])) + [(1000, 1000 + i) for i in range(1, 400)] + [(2000, 2000)]
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(20))
    of = {r["node"]: r["component"] for r in found.collect()}
    assert of == {**{i: 0 for i in range(n)}, **{1000 + i: 1000 for i in range(400)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
