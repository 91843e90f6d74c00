import hashlib

import numpy as np
import pytest

from patronage.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts, entries, rounds):
    """(vec_id, code, error, label_error, sha) by measuring every entry in every round."""
    kept = [(i, [int(np.floor(256 * x)) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    kept = [(i, v + [0] * (size * parts - len(v)), c, v) for i, v, c in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[3]))[:entries]
    books = [[r[1][p * size : (p + 1) * size] for r in first] for p in range(parts)]

    def nearest(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            own = {}
            for _, v, _, _ in kept:
                part = v[p * size : (p + 1) * size]
                own.setdefault(nearest(p, part)[1], []).append(part)
            moved.append([[sum(x) // len(x) for x in zip(*own[j])] if j in own else e for j, e in enumerate(books[p])])
        books = moved
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, of_label = [], {}
    for i, v, c, _ in kept:
        near = [nearest(p, v[p * size : (p + 1) * size]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in near), min(sum(d for d, _ in near), 2**63 - 1), c))
        of_label[c] = of_label.get(c, 0) + out[-1][2]
    return sorted(((i, code, e, min(of_label[c], 2**63 - 1), sha) for i, code, e, c in out), key=repr)


def found(df, **options):
    return sorted(map(tuple, vector_codes.digests(*vector_codes.compress(df, **options)).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    vectors = np.concatenate([c + rng.normal(0, 0.2, (80, 8)).round(2) for c in rng.normal(0, 1, (5, 8))])
    vectors[100:200] = vectors[100]  # a third are copies, and their parts tie
    rows = [(i, v.tolist(), i % 3 if i % 7 else None) for i, v in enumerate(rng.permutation(vectors))]
    odd = [(5000, None, 1), (5100, [1.0, None] + [0.0] * 6, 1), (5200, [float("nan")] * 8, 1), (None, [1.0] * 8, 1)]
    odd += [(5300, [float("inf")] * 8, None), (None, [0.5] * 8, None), (6000, [1.0, -2.0], 1), (6100, [], 1)]
    return rows + odd + rows[:50]


@pytest.mark.parametrize("options", [(4, 16, 2), (3, 7, 5), (8, 64, 0)])
def test_all_kinds_of_rows(spark, clashing, rows, options):
    parts, entries, rounds = options
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found(df, parts=parts, entries=entries, rounds=rounds) == brute(rows, *options)


def test_few_rows(spark):
    for rows in ([], [(0, [1.0], 0)], [(3, [], None), (4, [], 0)], [(0, [1e5, 2.0], 0), (1, [-3e9, 7.0], 0), (1, [2e9, 7.0], 1)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert found(df, parts=2, entries=2, rounds=2) == brute(rows, 2, 2, 2)


def test_net_displacement_is_tighter_than_the_sum_of_moves():
    """Over many rounds: the same codes as full rescans, fewer of them than with added moves."""
    rng = np.random.default_rng(4)
    rows = np.concatenate([c + rng.integers(-60, 60, (200, 4)) for c in rng.integers(-400, 400, (24, 4))])
    history, n = [rows[:24].copy()], len(rows)
    code, stamp, bound = np.zeros(n, np.uint8), np.zeros(n, np.uint8), np.full(n, -np.inf)
    summed, by_net, by_sum, full = np.full(n, -np.inf), 0, 0, 0
    for number in range(12):
        bounds = vector_codes.Bounds(history)
        squares = vector_codes._squares(rows, history[-1])
        if number:
            step = vector_codes.Bounds(history[-2:]).others(code, np.zeros(n), np.zeros(n, np.int64))
            summed = summed + step
            assert (summed <= bounds.others(code, bound, stamp) + 1e-6).all()
            by_sum += int((~(np.sqrt(squares[np.arange(n), code]) < summed)).sum())
        code, bound, stamp, square, again = bounds.assign(rows, code, bound, stamp)
        assert (code == squares.argmin(axis=1)).all() and (square == squares.min(axis=1)).all()
        fresh = stamp == number
        summed[fresh] = bound[fresh]
        by_net, full = by_net + (again if number else 0), full + (n if number else 0)
        history.append(np.array([rows[code == j].sum(0) // max((code == j).sum(), 1) if (code == j).any() else history[-1][j] for j in range(24)]))
    assert by_net < by_sum < full
