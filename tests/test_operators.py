"""Operators against brute force on small inputs, hot keys among them."""

import math
import random
import re

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.operators import affinity, clustering, keyed, kmeans, ranking, rules, silhouette
from patronage.operators.crosstab import association, crosstab, pair_counts
from patronage.operators.groups import attach, group_profiles, place_sums
from patronage.operators.matching import like_matches, longest_names
from patronage.operators.ranking import best_rules, latest_k, top_per_group
from patronage.schemas import FEATURES


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- keyed writes ---------------------------------------------------------------------------------


def _write_by_hand(target, source, update):
    state = {r[0]: dict(zip(("a", "b", "made"), r[1:])) for r in target}
    for key, order, a, b, made in sorted(source, key=lambda r: r[1]):
        new = {"a": a, "b": b, "made": made}
        if key in state and update is not None:
            state[key] |= {c: new[c] for c in update}
        else:
            state[key] = new
    return sorted(((k, v["a"], v["b"], v["made"]) for k, v in state.items()), key=repr)


def test_upsert_and_replace_like_row_by_row_writes(spark):
    rng = random.Random(1)
    target = [(f"k{i}", i, f"b{i}", "old") for i in range(20)] + [("kept", 1, "b", "old")]
    # a third of all source rows share one key
    source = [
        ("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", i, rng.choice([None, i]), f"s{i}", f"new{i}") for i in range(300)
    ]
    t = spark.createDataFrame(target, "key string, a int, b string, made string")
    s = spark.createDataFrame(source, "key string, ord int, a int, b string, made string")
    assert rows(keyed.upsert(t, s, ["key"], ["ord"], ["a", "b"])) == _write_by_hand(target, source, ["a", "b"])
    assert rows(keyed.upsert(t, s, ["key"], ["ord"], [])) == _write_by_hand(target, source, [])
    assert rows(keyed.replace(t, s, ["key"], ["ord"])) == _write_by_hand(target, source, None)
    once = keyed.upsert(t, s, ["key"], ["ord"], ["a", "b"])
    assert rows(keyed.upsert(once, s, ["key"], ["ord"], ["a", "b"])) == rows(once)
    short = s.drop("made")
    assert {r["made"] for r in keyed.replace(t, short, ["key"], ["ord"]).collect()} == {None, "old"}
    nulls = t.limit(1).withColumn("key", F.lit(None).cast("string"))
    merged = keyed.upsert(t.unionByName(nulls), s.limit(2).withColumn("key", F.lit(None).cast("string")), ["key"], ["ord"], ["b"])
    assert merged.count() == t.count() + 1 and merged.filter("key IS NULL").first()["b"] == "s1"
    assert keyed.dedupe_last(s, ["key"], ["ord"]).filter("key = 'hot'").first()["ord"] == 297


def test_backfill(spark):
    df = spark.createDataFrame([(1, None), (1, 0.5), (2, None)], "k int, acc double")
    assert rows(keyed.backfill(df, "acc", F.lit(0.9), F.col("k") == 1)) == [(1, 0.5), (1, 0.9), (2, None)]


# --- ranking --------------------------------------------------------------------------------------


def test_ranking(spark):
    df = spark.createDataFrame([("g", n, v) for n, v in [("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", 0.0)]], "g string, n string, v double")
    assert [(r["n"], r["rank"]) for r in top_per_group(df, ["g"], "v", "n", 3).orderBy("rank").collect()] == [("c", 1), ("a", 2), ("b", 3)]
    table = [(4, 5, 0, 0.9, 10, 2), (3, 5, 0, 0.9, 10, 2), (2, 5, 0, 0.9, 10, 3), (1, 5, 0, 0.9, 9, 1), (9, 5, 1, 0.1, 1, 1)]
    made = spark.createDataFrame(table, "rule_id long, k int, cluster_id int, rule_precision double, support long, depth int")
    assert {(r["cluster_id"], r["rule_id"]) for r in best_rules(made).collect()} == {(0, 3), (1, 9)}
    runs = spark.createDataFrame([("2024", 3), ("2025", 4), ("2025", 6)], "created_at string, k int")
    assert latest_k(runs).collect() == [(6,)]
    assert latest_k(runs.limit(0)).collect() == [(None,)]


# --- matching -------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits, size", [(18, 2_000_000), (3, 50)])
def test_longest_names_like_a_scan(spark, bits, size):
    """Also where all anchors share a few places of the table, and with a few texts a slice."""
    rng = random.Random(2)
    names = sorted({"".join(rng.choice("ab왕") for _ in range(rng.randint(1, 4))) for _ in range(25)}) + ["", "b왕ab a왕 왕", "aab" * 130]
    texts = ["".join(rng.choice("ab왕 ") for _ in range(rng.randint(0, 30))) for _ in range(60)] + ["aab" * 400, None, "", "x b왕ab a왕 왕", "b왕ab a왕 ", "왕"]
    kinds = [("area" if i % 2 else "sector", n) for i, n in enumerate(names)]
    got = longest_names(
        spark.createDataFrame(list(enumerate(texts)), "id int, text string"),
        "id",
        "text",
        spark.createDataFrame(kinds, "kind string, name string"),
        bits,
        size,
    )
    want = []
    for i, text in enumerate(texts):
        for kind in ("area", "sector"):
            fits = sorted((-len(n), n) for k, n in kinds if k == kind and n and n in (text or ""))
            if fits:
                want.append((i, kind, fits[0][1]))
    assert rows(got) == sorted(want, key=repr)


def test_longest_names_meets_names_once_a_text(spark, monkeypatch):
    """However often names stand in a text and whatever stands around them, few rows come to a join."""
    texts = spark.createDataFrame([(0, "".join(f"{i}name{i}" for i in range(3000))), (1, "x" * 3000)], "id int, text string")
    names = spark.createDataFrame([("word", "name"), ("word", "am"), ("word", "name123"), ("word", "names")], "kind string, name string")
    joined, join = [], type(texts).join

    def counted(self, *args, **kwargs):
        joined.append(self.count())
        return join(self, *args, **kwargs)

    monkeypatch.setattr(type(texts), "join", counted)
    assert rows(longest_names(texts, "id", "text", names)) == [(0, "word", "name123")]
    assert max(joined) < 20


def _like(param, value):
    out, i = "", 0
    while i < len(param):
        c = param[i]
        if c == "\\" and i + 1 < len(param):
            i += 1
            out += re.escape(param[i])
        else:
            out += ".*" if c == "%" else "." if c == "_" else re.escape(c)
        i += 1
    return re.search(out, value, re.IGNORECASE | re.DOTALL) is not None


def test_like_matches_like_a_scan(spark):
    params = ["seoul", "SEO", "n_tion", "NATION_1", "a%b", "%", "_", "", "100\\%", "x\\_y", "강남", "(", "a.c", "___%"]
    values = ["Seoul city", "NATION_1", "NATION_10", "nation-1", "aXXb", "100% fun", "100 fun", "x_y", "xzy", "강남구", "f(x)", "abc", "a.c", "q", ""]
    got = like_matches(
        spark.createDataFrame([(p,) for p in params + [None]], "param string"),
        spark.createDataFrame([(v,) for v in values + [None, "Seoul city"]], "value string"),
    )
    assert rows(got) == sorted([(p, v) for p in params for v in values if _like(p, v)], key=repr)


def _shops(spark, n=400):
    rng = random.Random(3)
    zones, districts, sectors = ["Zone 1", "Zone 10", None], ["East", "West zone"], ["Cafe", "Bar", None]
    data, clusters = [], []
    for i in range(n):
        hot = i % 3 == 0  # a third of all rows belong to one shop and place
        shop = "hot" if hot else f"s{i % 60}"
        place = ("Zone 1", "East", "Cafe") if hot else (zones[i % 3], districts[i % 2], sectors[(i // 2) % 3])
        data.append((shop, f"{2000 + i}", *place, *[round(rng.random(), 4) for _ in range(10)], rng.choice([0, 1, None]), 1))
    for shop in {d[0] for d in data}:
        if rng.random() < 0.8:
            clusters.append((shop, rng.randrange(3)))
    kinds = ", ".join(f"{f} {'int' if f.endswith('high') else 'decimal(6,4)'}" for f in FEATURES)
    from decimal import Decimal

    typed = [tuple(Decimal(str(v)) if isinstance(v, float) else v for v in d) for d in data]
    features = spark.createDataFrame(typed, f"mct_id string, ym string, biz_zone string, sigungu string, sector string, {kinds}")
    return data, clusters, features, spark.createDataFrame(clusters, "mct_id string, cluster_id int")


def test_group_profiles_like_a_scan(spark):
    data, clusters, features, cluster_df = _shops(spark)
    label = dict(clusters)
    params = [("zone 1", None), ("zone", "cafe"), (None, "bar"), (None, None), ("nowhere", None), ("_one", "a"), ("east", "CAFE")]
    asked = spark.createDataFrame([(i, *p) for i, p in enumerate(params * 2)], "request_id int, area string, sector string")
    answers = group_profiles(asked, place_sums(features, cluster_df))
    assert answers.count() == len(params)
    got = {(r["area"], r["sector"]): r for r in answers.collect()}
    for area, sector in params:
        fit = [
            d
            for d in data
            if (area is None or any(p is not None and _like(area, p) for p in d[2:4]))
            and (sector is None or (d[4] is not None and _like(sector, d[4])))
        ]
        row = got[area, sector]
        assert row["n"] == len(fit)
        for j, f in enumerate(FEATURES):
            known = [d[5 + j] for d in fit if d[5 + j] is not None]
            if known:
                assert math.isclose(float(row[f]), sum(known) / len(known), abs_tol=1e-8)
            else:
                assert row[f] is None
        counts = {}
        for d in fit:
            if d[0] in label:
                counts[label[d[0]]] = counts.get(label[d[0]], 0) + 1
        best = min(counts, key=lambda c: (-counts[c], c)) if counts else 0
        assert row["cluster_id"] == best
    assert attach(asked, answers).count() == len(params) * 2


# --- association ------------------------------------------------------------------------------------


def _by_hand(table):
    o = np.array(table, dtype=float)
    o = o[o.sum(1) > 0][:, o.sum(0) > 0]
    n, dof = o.sum(), (o.shape[0] - 1) * (o.shape[1] - 1)
    e = np.outer(o.sum(1), o.sum(0)) / n
    gap = np.abs(o - e)
    if dof == 1:
        gap -= np.minimum(0.5, gap)
    chi2 = float((gap**2 / e).sum()) if dof else 0.0
    width = min(o.shape) - 1
    return chi2, dof, math.sqrt(chi2 / n / width) if width else 0.0, int(n)


@pytest.mark.parametrize(
    "table",
    [[[30, 10], [5, 20]], [[10, 10], [10, 10]], [[0, 7], [9, 0]], [[3, 4, 5]], [[1, 2, 0], [0, 5, 9]], [[900, 1], [0, 1], [50, 3]]],
)
def test_association(spark, table):
    cells = [(f"r{i}", f"c{j}") for i, line in enumerate(table) for j, n in enumerate(line) for _ in range(n)]
    df = spark.createDataFrame(cells + [("r0", None), (None, "c0")], "a string, b string")
    got = association(pair_counts(df, {"p": ("a", "b")})).first()
    chi2, dof, v, n = _by_hand(table)
    assert (got["dof"], got["n"]) == (dof, n)
    assert math.isclose(got["chi2"], chi2, rel_tol=1e-9, abs_tol=1e-9)
    assert math.isclose(got["cramers_v"], v, rel_tol=1e-9, abs_tol=1e-9)
    if dof == 1:
        assert math.isclose(got["p_value"], math.erfc(math.sqrt(chi2 / 2)), rel_tol=1e-9)
    full = {(r["row_cat"], r["col_cat"]): r["n"] for r in crosstab(df, "a", "b", ["c0", "c1", "c2", "c3"]).collect()}
    kept = [i for i, line in enumerate(table) if sum(line)], [j for j in range(len(table[0])) if sum(r[j] for r in table)]
    assert full == {(f"r{i}", f"c{j}"): table[i][j] for i in kept[0] for j in kept[1]}


# --- silhouette -------------------------------------------------------------------------------------


def _silhouette_by_hand(x, labels, power):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)) ** power
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(scores))


def test_silhouette_like_brute_force(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(60, 3)) + rng.integers(0, 3, size=(60, 1)) * 2
    weights = rng.integers(1, 5, size=60)
    weights[0] = 120  # a third of all rows are one point
    one, two = rng.integers(0, 3, size=60), (points[:, 0] > 1).astype(int)
    one[5] = 9  # its own cluster, and a gap in the labels
    weights[5] = 1
    flat = np.zeros(60, dtype=int)
    data = [
        (*map(float, p), int(w), int(a), int(b), int(c)) for p, w, a, b, c in zip(points, weights, one, two, flat)
    ]
    df = spark.createDataFrame(data, "x double, y double, z double, w int, one int, two int, flat int")
    numbered = silhouette.numbered(df, "id")
    keyed = numbered.withColumn("key", kmeans.sample_key("w", ["x", "y", "z"], 1))
    rows_of = np.repeat(np.arange(60), weights)
    x = points[rows_of]
    for power, got in (
        (1, silhouette.euclidean(numbered, "id", ["x", "y", "z"], ["one", "two", "flat"], "w")),
        (1, silhouette.euclidean(numbered, "id", ["x", "y", "z"], ["one", "two", "flat"], "w", tile_points=7)),
        (1, silhouette.sampled(keyed, ["x", "y", "z"], ["one", "two", "flat"], "w", "key", 60)),
        (2, silhouette.squared(numbered, ["x", "y", "z"], ["one", "two", "flat"], "w")),
    ):
        assert math.isclose(got["one"], _silhouette_by_hand(x, one[rows_of], power), rel_tol=1e-6)
        assert math.isclose(got["two"], _silhouette_by_hand(x, two[rows_of], power), rel_tol=1e-6)
        assert got["flat"] == -1.0


# --- clustering -------------------------------------------------------------------------------------


def _blobs(spark):
    rng = random.Random(5)
    data = []
    for i in range(300):
        c = i % 3
        data.append((f"m{i}", "202401", *[round((c == j % 3) * 0.6 + rng.random() * 0.2, 2) for j in range(10)], c == 0, None))
    data += [("hot", f"{i}", *[0.5] * 10, True, None) for i in range(150)]
    kinds = ", ".join(f"{f} {'boolean' if f.endswith('high') else 'double'}" for f in FEATURES)
    df = spark.createDataFrame(data, f"mct_id string, ym string, {kinds}")
    return df.withColumns({f: F.col(f).cast("int") for f in ("cancel_high", "delivery_high")})


def test_segments(spark):
    df = _blobs(spark)
    best, found = clustering.choose_segments(df, FEATURES, (2, 3, 4))
    assert best.silhouette == max(s.silhouette for s in found) and best.measure == "euclidean"
    labelled = best.label(df)
    sizes = {r["cluster_id"]: r["n"] for r in labelled.groupBy("cluster_id").agg(F.count("*").alias("n")).collect()}
    assert sorted(sizes) == list(range(best.k))
    assert [sizes[i] for i in range(best.k)] == sorted(sizes.values(), reverse=True)
    x = np.array([r["v"] for r in clustering.fill_missing(df, FEATURES).select(F.array(*FEATURES).alias("v")).collect()])
    assert np.allclose(best.scaler.means, x.mean(0))
    deviation = x.std(0)
    assert np.allclose(best.scaler.deviations, np.where(deviation == 0, 1, deviation))
    z = (x - x.mean(0)) / np.where(deviation == 0, 1, deviation)
    centers = np.array(best.centers)
    assert math.isclose(best.inertia, (((z[:, None, :] - centers[None]) ** 2).sum(-1)).min(1).sum(), rel_tol=1e-9)
    assert math.isclose(best.silhouette, _silhouette_by_hand(z, ((z[:, None, :] - centers[None]) ** 2).sum(-1).argmin(1), 1), rel_tol=1e-5)
    squared, _ = clustering.choose_segments(df, FEATURES, (2, 3, 4), measure="squared")
    assert squared.measure == "squared" and -1 <= squared.silhouette <= 1
    with pytest.raises(ValueError, match="measure"):
        clustering.choose_segments(df, FEATURES, (2,), measure="auto")


def test_partitions_change_nothing(spark):
    """Centres, labels, k and scores to the last bit on 1, 8 and 200 partitions, shuffled rows."""
    df = _blobs(spark)
    made = []
    for parts in (1, 8, 200):
        best, found = clustering.choose_segments(df.orderBy(F.rand(parts)).repartition(parts), FEATURES, (2, 3))
        made.append((best, found, rows(best.label(df).select("mct_id", "ym", "cluster_id"))))
    assert made[0] == made[1] == made[2]


def test_more_centres_than_points(spark):
    df = _blobs(spark).limit(2)
    best, found = clustering.choose_segments(df, FEATURES, (2, 3))
    assert [len(s.centers) for s in found] == [2, 2] and best.k == 2


def test_sampled_silhouette_tells_labellings_apart(spark):
    """A sample that grows until its errors tell the best labelling; estimates near the exact means."""
    rng = np.random.default_rng(7)
    points = np.concatenate([rng.normal(c, 0.4, (2000, 2)) for c in ((0, 0), (4, 0), (0, 4))])
    good = np.repeat([0, 1, 2], 2000)
    near = np.where(rng.random(6000) < 0.06, (good + 1) % 3, good)
    df = spark.createDataFrame([(*map(float, p), 1, int(a), int(b)) for p, a, b in zip(points, good, near)], "x double, y double, w int, good int, near int")
    keyed = df.withColumn("key", kmeans.sample_key("w", ["x", "y"], 1))
    got = silhouette.sampled(keyed, ["x", "y"], ["good", "near"], "w", "key", 64)
    assert got["good"] > got["near"]
    assert abs(got["good"] - _silhouette_by_hand(points[::6], good[::6], 1)) < 0.05


def test_the_same_rows_ten_times_choose_the_same(spark):
    df = _blobs(spark)
    one, _ = clustering.choose_segments(df, FEATURES, (2, 3, 4))
    ten, _ = clustering.choose_segments(df.crossJoin(spark.range(10)), FEATURES, (2, 3, 4))
    assert (one.k, one.measure) == (ten.k, ten.measure)
    assert math.isclose(one.silhouette, ten.silhouette, rel_tol=0.02) and math.isclose(10 * one.inertia, ten.inertia, rel_tol=1e-6)


def test_rules_of_the_newest_run_of_each_k(spark):
    rows = [(3, 1, 1), (3, 2, 2), (3, 2, 3), (4, 1, 4)]
    df = spark.createDataFrame(rows, "k int, created_at int, rule_id int")
    assert sorted(r["rule_id"] for r in ranking.newest_runs(df).collect()) == [2, 3, 4]


def test_missing_features_count_as_zero(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0), (0.5, 3.0)], "a double, b double")
    assert [r["a"] for r in clustering.fill_missing(df, ["a"]).collect()] == [0.0, 0.0, 0.5]
    scaler = clustering.fit_scaler(spark.createDataFrame([(-2.5e-7, 4.0), (-1.5e-7, 4.0)], "a double, b double"), ["a", "b"], None)
    assert np.allclose(scaler.means, [-2e-7, 4.0]) and np.allclose(scaler.deviations, [5e-8, 1.0])
    got = spark.createDataFrame([(-1.5e-7, 5.0)], "a double, b double").select(*scaler.columns()).first()
    assert np.allclose(list(got), [1.0, 1.0])


# --- rules ------------------------------------------------------------------------------------------


def test_split_is_exact_and_stable(spark):
    data = [(f"m{i}", "202401", 0 if i % 3 else i % 7) for i in range(1001)]
    df = spark.createDataFrame(data, "mct_id string, ym string, label int")
    train, test = rules.stratified_split(df, "label", ["mct_id", "ym"])
    sizes = dict(df.groupBy("label").count().collect())
    got = dict(test.groupBy("label").count().collect())
    assert sum(got.values()) == 201
    assert all(abs(got[c] - 0.2 * sizes[c]) <= 1 for c in sizes)
    assert rows(train.unionByName(test)) == rows(df)
    again = rules.stratified_split(df.repartition(13), "label", ["mct_id", "ym"])[1]
    assert rows(again) == rows(test)


def test_tree_rules(spark):
    df = clustering.fill_missing(_blobs(spark), FEATURES).withColumn(
        "cluster_id", F.when(F.col("age_10s") > 0.55, 2).when(F.col("age_30s") > 0.55, 1).otherwise(0)
    )
    tree = rules.fit_tree(df, FEATURES, "cluster_id")
    made = rules.extract_rules(tree, spark, 7)
    table = made.orderBy("rule_id").collect()
    assert [r["rule_id"] for r in table] == list(range(7, 7 + len(table)))
    assert sum(r["support"] for r in table) == df.count()
    assert all(0 < r["rule_precision"] <= 1 and r["depth"] == len(r["path"]) <= 3 for r in table)
    assert all(r["support"] >= 50 for r in table)
    by_tests = rules.matching_rules(df, made.select("rule_id", "path"), FEATURES).select("mct_id", "ym", "rule_id")
    by_leaf = rules.assign_rules(tree, made, df).select("mct_id", "ym", "rule_id")
    assert rows(by_tests) == rows(by_leaf)
    only = df.withColumn("cluster_id", F.lit(1))
    assert rules.extract_rules(rules.fit_tree(only, FEATURES, "cluster_id"), spark).count() == 0
    assert rules.extract_rules(rules.fit_tree(only.limit(0), FEATURES, "cluster_id"), spark).count() == 0


def _plain_tree(x, y, depth, min_leaf, tests=()):
    """Leaves (tests, counts) by trying every value of every feature."""
    counts = np.bincount(y, minlength=3)
    best = None
    for f in range(x.shape[1]) if depth and (counts > 0).sum() > 1 else ():
        values = np.unique(x[:, f])
        for low, high in zip(values, values[1:]):
            left = np.bincount(y[x[:, f] <= low], minlength=3).astype(object)
            right = counts - left
            if min(left.sum(), right.sum()) >= min_leaf:
                gain = Fraction((left**2).sum(), left.sum()) + Fraction((right**2).sum(), right.sum())
                if best is None or gain > best[0]:
                    best = gain, f, low + (high - low) / 2
    if best is None:
        return [(list(tests), counts.tolist())]
    _, f, t = best
    return [
        leaf
        for op, side in (("<=", x[:, f] <= t), (">", x[:, f] > t))
        for leaf in _plain_tree(x[side], y[side], depth - 1, min_leaf, [*tests, (f"f{f}", t, op)])
    ]


@pytest.mark.parametrize("bins", [3, 256])
@pytest.mark.parametrize("kind", ["rounded", "heavy", "one leads", "nothing to learn"])
def test_tree_equals_the_one_that_tries_every_value(spark, monkeypatch, bins, kind):
    monkeypatch.setattr(rules.tree, "BINS", bins)
    rng = np.random.default_rng(len(kind))
    x = rng.normal(size=(400, 3))
    x = np.exp(6 * x) if kind == "heavy" else x.round(1) if kind == "rounded" else x
    x[:130, 1] = x[0, 1]  # a value that a third of the rows share
    y = ((x[:, 0] > np.median(x[:, 0])).astype(int) + (x[:, 2] > 1)) * (rng.random(400) > 0.2)
    y = (rng.random(400) < 0.1).astype(int) + 0 if kind == "one leads" else y
    y = rng.integers(0, 3, 400) if kind == "nothing to learn" else y
    df = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], "f0 double, f1 double, f2 double, c int")
    want = _plain_tree(x, y, 3, 20)
    for parts in (1, 7):
        tree = rules.fit_tree(df.repartition(parts), ["f0", "f1", "f2"], "c", 3, 20)
        counts = [[int(n.counts[tree.classes.index(c)]) if c in tree.classes else 0 for c in range(3)] for n in tree.leaves]
        assert [(n.tests, c) for n, c in zip(tree.leaves, counts)] == want
    assert len(want) > 3


def test_rule_text(spark):
    path = [("age_40s", 0.25, "<="), ("aud_new", 0.0625, ">")]
    df = spark.createDataFrame([(path,)], f"path {rules.PATH_TYPE}")
    assert df.select(rules.rule_text("path")).first()[0] == "age_40s <= 0.250 AND aud_new > 0.062"


# --- affinity ---------------------------------------------------------------------------------------


def _cells(df, item):
    return {(r["age_group"], r[item]): float(r["affinity"]) for r in df.collect()}


def test_by_age_last_cell_wins(spark):
    df = spark.createDataFrame(
        [(1, "You Tube", "10%", "20%", "-"), (2, "youtube", "5", None, "40"), (3, "nan", "1", "1", "1"), (4, "You tube", "30%", "x", "50%")],
        ["row_ord", "매체명", "10대", "20대", "60대 이상"],
    )
    assert _cells(affinity.media_affinity(df), "channel") == {
        ("10s", "you_tube"): 0.3, ("60p", "you_tube"): 0.5, ("10s", "youtube"): 0.05, ("60p", "youtube"): 0.4,
    }


def test_span_layouts(spark):
    media = spark.createDataFrame(
        [(1, "10", "19", "TV", "50", "Web", "10"), (2, "20", "29", "TV", "30", "nan", "9"), (3, None, "29", "tv", "5%", "Web", "-")],
        ["row_ord", "최소나이", "최대나이", "매체1", "접촉률1", "매체2", "주간 접촉"],
    )
    assert _cells(affinity.media_affinity(media), "channel") == {("10s", "tv"): 0.4, ("10s", "web"): 0.1, ("60p", "tv"): 0.05}
    interest = spark.createDataFrame(
        [(1, "30", "39", "맛 집", "50", "20", "7"), (2, "30", "39", "맛집", "30", "x", None)],
        ["row_ord", "min_age", "max_age", "관심", "관심_비율", "뷰티 _전체", "other비율"],
    )
    assert _cells(affinity.interest_affinity(interest), "keyword") == {("30s", "맛집"): 0.4, ("30s", "뷰티 _전체"): 0.2}
    with pytest.raises(ValueError):
        affinity.media_affinity(spark.createDataFrame([(1, "x")], ["row_ord", "매체"]))


def test_turned_sheet_later_platform_wins(spark):
    down = spark.createDataFrame([(1, "10대", "10", "40"), (2, "20대", "30", None)], ["row_ord", "구분", "You Tube", "you_tube"])
    assert _cells(affinity.video_affinity(down), "channel") == {("10s", "you_tube"): 0.4}
    same = spark.createDataFrame([(1, "10대", "10", "40")], ["row_ord", "구분", "You Tube", "x"]).toDF("row_ord", "구분", "You Tube", "you tube")
    assert _cells(affinity.video_affinity(same), "channel") == {("10s", "you_tube"): 0.4}


def test_means_are_rounded_once(spark):
    # 0.03004999... would become 0.0301 by way of eight decimals
    rows = [(i, "10", "19", "tv", x) for i, x in enumerate(["0.03", "0.0301", "0.03", "0.0301", "0.0300", "0.0301", "0.03"])]
    media = spark.createDataFrame(rows, ["row_ord", "최소나이", "최대나이", "매체1", "접촉률1"])
    assert _cells(affinity.media_affinity(media), "channel") == {("10s", "tv"): 0.03}
    even = spark.createDataFrame(rows[:2], ["row_ord", "최소나이", "최대나이", "매체1", "접촉률1"])
    assert _cells(affinity.media_affinity(even), "channel") == {("10s", "tv"): 0.03}


def test_video_layouts(spark):
    down = spark.createDataFrame([(1, "10대", "10%", "20"), (2, "20대", "30%", None), (3, "60대 이상", "5", "6")], ["row_ord", "구분", "You Tube", "TV"])
    assert _cells(affinity.video_affinity(down), "channel") == {
        ("10s", "you_tube"): 0.3, ("10s", "tv"): 0.2, ("60p", "you_tube"): 0.05, ("60p", "tv"): 0.06,
    }
    assert affinity.video_affinity(spark.createDataFrame([(1, "x", "1")], ["row_ord", "a", "b"])) is None
    media = spark.createDataFrame([(1, "TV", "10", "20")], ["row_ord", "media", "10대", "30대"])
    video = spark.createDataFrame([(1, "tv", "50")], ["row_ord", "service", "10대"])
    interest = spark.createDataFrame([(1, "k", "10")], ["row_ord", "keyword", "10대"])
    channels, keywords = affinity.load_affinity(media, interest, video, "v1")
    assert _cells(channels, "channel") == {("10s", "tv"): 0.5, ("30s", "tv"): 0.2}
    assert _cells(keywords, "keyword") == {("10s", "k"): 0.1}


def test_cells_written_alike_are_read_once(spark):
    given = [(i, "20", "29", f"m{i % 2}", "35%", "x", "1.5%") for i in range(40)] + [(40, "20", "29", "m0", "0.1", "", "7%")]
    table = spark.createDataFrame(given, ["row_ord", "최소나이", "최대나이", "매체1", "접촉률1", "매체2", "접촉률2"])
    made = affinity.media_affinity(table)
    plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
    count = max(i for i, line in enumerate(plan) if "Aggregate" in line)
    assert not any("RLIKE" in line for line in plan[count:])  # nothing is read as a number before the count
    assert {(a, c, float(v)) for a, c, v in made.collect()} == {("10s", "m0", 0.3381), ("10s", "m1", 0.35), ("10s", "x", 0.015)}
