import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, positives=5, negatives=5):
    width, kept = max((len(v) for _, v, _ in rows if v), default=0), set()
    for i, v, label in rows:
        if None not in (i, label, v) and all(x is not None and np.isfinite(x) for x in v):
            kept.add((i, tuple(int(np.floor(256 * x)) for x in v) + (0,) * (width - len(v)), label))
    out = []
    for a, v, label in kept:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, w, other in kept if i != a)
        for p_score, p, _ in [s for s in scored if s[2] == label][:positives]:
            some = [s for s in scored if s[2] != label and 80 * -p_score <= 100 * -s[0] <= 100 * -p_score]
            out += [(a, p, n + 1, i, -p_score, -s) for n, (s, i, _) in enumerate(some[:negatives])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    vectors = np.concatenate([c + rng.normal(0, 0.3, (150, 6)).round(2) for c in rng.normal(0, 1, (5, 6))])
    labels = rng.integers(0, 4, len(vectors))
    labels[:250] = 1  # a hot label
    vectors[200:400] = vectors[200]  # copies, whose scores tie
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(vectors, labels))]
    odd = [(5000, None, 1), (5100, [1.0, None] + [0.0] * 4, 1), (5200, [float("nan")] * 6, 1), (5300, [1.0] * 6, None)]
    odd += [(5400, [float("inf")] * 6, 2), (None, [1.0] * 6, 1), (6000, [1.0, -2.0], 1), (6100, [], 1), (6200, [0.0] * 6, 2)]
    return rows + odd + rows[:50]


@pytest.mark.parametrize("tiles", [(40, 2, 3), (8192, 8192, 128)])
def test_all_kinds_of_rows(spark, clashing, rows, monkeypatch, tiles):
    for name, size in zip(("BLOCK", "ANCHOR_BLOCK", "STRIP"), tiles):
        monkeypatch.setattr(hard_negatives, name, size)
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(3))
    found = hard_negatives.mine(df, F.col("vec_id") % 100 == 0)
    want = brute(rows)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 50


def test_few_rows(spark):
    one, two = (0, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)
    for rows in ([], [one], [one, two], [one, two, (2, [1.0, 1.9], 1)], [(0, [], 0), (1, [], 0), (2, [], 1)]):
        found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0)
        assert sorted(map(tuple, found.collect())) == brute(rows)


@pytest.mark.parametrize("most, fields", [(1, 10), (300, 2), (2**20, 1), (2**32, 8)])
def test_packed_products(most, fields):
    rng = np.random.default_rng(most % 97)
    rows, anchors = rng.integers(-most, most + 1, (101, 9)), rng.integers(-most, most + 1, (7, 9))
    rows[0], anchors[0] = -most, most
    packed = hard_negatives.Packed(rows, anchors)
    assert packed.fields >= min(fields, 2) and (packed.kind is object) == (most == 2**32)
    assert packed.packed.shape[1] == -(-101 // packed.fields)
    assert (packed.scores(anchors).astype(object) == anchors.astype(object) @ rows.T.astype(object)).all()
