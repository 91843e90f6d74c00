import brute
import numpy as np
import pytest

from patronage.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<{}>, label int"


def expected(rows, cosine=0.95):
    width = max((len(v) for _, v, _ in rows if v), default=0)

    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    vectors = [np.array([*v, *[0.0] * (width - len(v))], float) if usable(v) else None for _, v, _ in rows]
    links = []
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors[:i]):
            if a is not None and b is not None:
                x, y = a / np.abs(a).max(), b / np.abs(b).max()
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= cosine:
                    links.append((i, j))
    count = np.bincount(np.array(links, int).reshape(-1), minlength=len(rows))
    group = brute.groups(range(len(rows)), links)
    least = {}
    for i, (vec, _, _) in enumerate(rows):
        if vec is not None:
            least[group[i]] = min(least.get(group[i], vec), vec)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        of = vec if vectors[i] is None else least.get(group[i])
        out.append((vec, int(count[i]), of, vec is not None and vec == of))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    rows = []
    for centre in rng.normal(size=(30, 16)):
        rows += [(centre + rng.normal(0, s, 16)).tolist() for s in rng.choice([0.0, 0.1, 0.25, 0.5], 12)]
    rows[50:150] = [rows[0]] * 100  # a group of copies
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(rows)]
    odd = [(1000, None, 1), (1001, [1.0, None], 1), (1002, [float("nan")] * 16, 1), (1003, [0.0] * 16, None)]
    odd += [(1004, [], 1), (None, rows[3][1], 1), (None, None, 1), (1005, [2.0], 1), (1006, [3.0, -0.0], 1)]
    return rows + odd + rows[:20]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_all_kinds_of_rows(spark, clashing, rows, monkeypatch, kind):
    monkeypatch.setattr(embedding_dedup, "STRIP", 7)
    df = clashing(spark.createDataFrame(rows, SCHEMA.format(kind)))
    found = embedding_dedup.near_duplicates(df, tile=20, cells=6)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_large_and_small_numbers(spark):
    rows = [(0, [1e300, 1e300], 0), (1, [1e-300, 1e-300], 0), (2, [1e300, -1e300], 0), (3, [5e-324, 0.0], 0)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA.format("double")))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    vectors = rng.normal(size=(300, 64))
    vectors[150:] = vectors[:150] + rng.normal(0, 0.33, (150, 64))  # cosines close to the threshold
    table = pa.table({"node": np.arange(300), "copies": np.ones(300, int), "vector": list(vectors)})
    tile = embedding_dedup._Tile(table, 64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for cosine in (0.9, 0.95):
        found = {(int(a), int(b)) for p, q in embedding_dedup._linked(tile, tile, True, cosine) for a, b in zip(p, q)}
        assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= cosine, 1)))}


def test_few_rows(spark):
    for rows in ([], [(0, None, 0)], [(5, [1.0], 0)], [(5, [1.0], 0), (5, [1.0], 0)]):
        found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA.format("float")))
        assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_vectors_that_do_not_cluster_are_dealt_by_number(spark, monkeypatch):
    """One copy for each tile of all vectors, not for each cell; clustered ones meet their own cells only."""
    dealt, deal = [], embedding_dedup._dealt
    monkeypatch.setattr(embedding_dedup, "_dealt", lambda placed, met: dealt.append(deal(placed, met).count()) or deal(placed, met))
    rng = np.random.default_rng(5)
    apart = rng.normal(size=(600, 32))
    centres = np.repeat(rng.normal(size=(20, 32)), 30, axis=0)
    for rows, copies in ((apart, 3), (centres + rng.normal(0, 0.01, centres.shape), 1)):
        df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
        found = embedding_dedup.near_duplicates(df, tile=200, cells=20)
        assert {r["vec_id"]: r["n_links"] for r in found.collect()} == dict(enumerate(links.tolist()))
        assert dealt.pop() == copies * 600
