import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def expected(rows, min_length, min_docs):
    """(doc_id, n_lines, n_dropped, text) by plain sets."""
    held = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_length and doc_id is not None:
                held.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        goes = [len(held.get(key(x), ())) >= min_docs and max(held[key(x)]) != doc_id for x in lines]
        out.append((doc_id, len(lines), sum(goes), "\n".join(x for x, g in zip(lines, goes) if not g)))
    return sorted(out, key=repr)


def found(docs, *options):
    out = line_dedup.dedup(docs, *options).select("doc_id", "n_lines", "n_dropped", "text")
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("probes", [7, 500_000])
def test_all_kinds_of_lines(spark, odd_docs, clashing, monkeypatch, probes):
    monkeypatch.setattr(line_dedup, "SHARD_PROBES", probes)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    rng = np.random.default_rng(1)
    lines = [f"shared line {i} é" for i in range(12)] + ["short", "", " \x0b ", "ŉ\x1c spaces around  "]
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    for i in range(60):
        chosen = [lines[j] for j in rng.integers(0, len(lines), rng.integers(1, 9))] + [f"own line of document {i}"]
        rows.append((100 + i % 55 if i % 9 else None, "\n".join(f" {x.upper() if i % 2 else x}\t" for x in chosen)))
    rows += rows[-5:]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wide = clashing(docs).withColumn("n_lines", F.lit("x"))
    assert found(wide, 10, 5) == expected(rows, 10, 5)
    kept = set(wide.columns) | {"n_dropped"}
    assert set(line_dedup.dedup(wide).columns) == kept


def test_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = expected(rows, 40, 5)
    assert found(docs) == want and sum(r[2] for r in want) > 0


def test_nothing_to_drop(spark, odd_docs):
    assert found(odd_docs.limit(0)) == []
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert found(odd_docs, 40, 50) == expected(rows, 40, 50)


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(3)
    low, high = rng.integers(0, 2**63, (2, 20_000)).astype(np.uint64)
    low[:100] = low[0]  # half a key may be equal
    made = line_dedup.PerfectHash.build(low, high)
    assert sorted(made.slots(low, high).tolist()) == list(range(20_000))
    assert sum(b.nbytes for b in made.levels) * 8 < 5 * 20_000
    strange = rng.integers(0, 2**63, (2, 1000)).astype(np.uint64)
    assert made.slots(*strange).max() < 20_000
    assert line_dedup.PerfectHash.build(low[:0], high[:0]).slots(low[:3], high[:3]).tolist() == [-1] * 3
