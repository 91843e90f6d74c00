import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k):
    """By all inner products; shorter vectors end in zeros."""
    kept, width = set(), max((len(v) for i, v, _ in rows if v), default=0)
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.add((i, tuple(int(np.floor(1024 * x)) for x in v) + (0,) * (width - len(v))))
    out = []
    for q, a in kept:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in kept if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    rows = []
    for centre in rng.normal(0, 20, (8, 6)):
        rows += [(centre + rng.normal(0, 0.05, 6).round(2)).tolist() for _ in range(100)]
    rows[100:400] = [rows[0]] * 300  # a third are copies, whose scores tie
    rows = [(i, v, 0) for i, v in enumerate(rows)]
    odd = [(5000, None, 1), (5100, [1.0, None] + [0.0] * 4, 1), (5200, [float("nan")] * 6, 1)]
    odd += [(5300, [float("inf")] * 6, None), (None, [1.0] * 6, 1), (6000, [1.0, -2.0], 1), (6100, [], 1)]
    return rows + odd + rows[:50]


@pytest.mark.parametrize("k", [1, 10])
def test_all_kinds_of_rows(spark, clashing, rows, monkeypatch, k):
    monkeypatch.setattr(topk, "BLOCK", 90)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    df = clashing(spark.createDataFrame(rows, SCHEMA)).drop("rank", "score")
    found = topk.search(df, F.col("vec_id") % 100 == 0, k)
    assert sorted(map(tuple, found.collect())) == brute(rows, k)


def test_pruning_drops_pairs(spark, rows, monkeypatch):
    seen, walk = [], topk.CoverTree.pairs

    def pairs(self, queries, data, worst):
        found = walk(self, queries, data, worst)
        seen.append((len(found), int((queries.n > 0).sum() * (data.n > 0).sum())))
        return found

    monkeypatch.setattr(topk.CoverTree, "pairs", pairs)
    topk.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, 10).collect()
    assert seen[0][0] < seen[0][1] / 2


def _share(x, tree, k=10):
    """Share of all products that are left by bounds at the true kth score of every hundredth row's group."""
    far = topk.distances(x, tree.centres[tree.leaf])
    leaf = far.argmin(axis=1)

    def reach(ids):
        out = topk.Reach(len(tree.leaf))
        np.maximum.at(out.radius, leaf[ids], far[ids, leaf[ids]])
        np.maximum.at(out.norm, leaf[ids], np.linalg.norm(x[ids], axis=1))
        np.add.at(out.n, leaf[ids], 1)
        return out

    asked = np.arange(0, len(x), 100)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    worst = np.full(len(tree.leaf), np.inf)
    np.minimum.at(worst, leaf[asked], np.sort(scores, axis=1)[:, -k])
    queries, data = reach(asked), reach(np.arange(len(x)))
    pairs = tree.pairs(queries, data, worst)
    best = {(leaf[q], leaf[p]) for i, q in enumerate(asked) for p in np.argsort(-scores[i], kind="stable")[: k - 1]}
    assert best <= set(pairs)
    return sum(int(queries.n[a] * data.n[b]) for a, b in pairs) / (len(asked) * len(x))


def test_depth_and_share_of_products(spark, sf_dir):
    """Several levels, and few products where rows cluster. The sample tables' 64 components don't: there
    nearly all products are left, whatever the tree (README)."""
    rng = np.random.default_rng(0)
    rows = np.concatenate([c + rng.normal(0, 30, (100, 64)) for c in rng.normal(0, 200, (20, 64))]).round()
    tree = topk.CoverTree(rows, 64)
    assert tree.depth >= 4 and _share(rows, tree) < 0.1
    sample = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").toArrow()["embedding"]
    rows = np.floor(1024 * np.array(sample.to_pylist(), dtype=float))
    tree = topk.CoverTree(rows, 64)
    assert tree.depth >= 2 and _share(rows, tree) <= 1.0


def test_few_rows(spark):
    for rows in ([], [(0, [1.0], 0)], [(0, [1.0], 0), (1, [2.0], 0)], [(1, [1.0], 0)], [(0, [], 0), (3, [], 0)]):
        found = topk.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, 10)
        want = [] if not rows or not any(r[1] for r in rows) else brute(rows, 10)
        assert sorted(map(tuple, found.collect())) == want


def test_large_numbers_stay_exact():
    a, b = np.array([[2**30, 3]]), np.array([[2**30, 1], [2**30 - 1, 7]])
    assert topk._products(a, b).tolist() == [[2**60 + 3, 2**30 * (2**30 - 1) + 21]]


def test_radii_cover_what_is_below():
    rows = np.random.default_rng(2).normal(size=(400, 3))
    tree = topk.CoverTree(rows, 20)
    far = topk.distances(rows, tree.centres[tree.leaf])
    leaf = far.argmin(axis=1)
    reach = np.full(len(tree.leaf), -1.0)
    np.maximum.at(reach, leaf, far[np.arange(len(rows)), leaf])
    radii = tree.radii(reach)

    def below(node):
        return [node, *(x for c in tree.children[node] for x in below(c))]

    for node in range(len(tree.rows)):
        of = [i for i, n in enumerate(tree.leaf.tolist()) if n in set(below(node))]
        inside = rows[np.isin(leaf, of)]
        if len(inside):
            assert np.linalg.norm(inside - tree.centres[node], axis=1).max() <= radii[node] + 1e-9
