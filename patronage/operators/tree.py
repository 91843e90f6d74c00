"""Classification trees out of grouped histograms, with exact thresholds and every leaf kept.

A level of the tree is searched in rounds. A round is one aggregate over the rows: counts of every class
by node, feature and bin, with the least and largest value of the bin; the driver sees nodes x features
x bins rows. Splits between two bins are known exactly. A split inside a bin can't be better than the
best corner of what the bin may send left, since the gain is convex in the counts, so only bins whose
bound is above the best split are cut into finer bins in the next round, down to single values if need
be. The result is the same as that of trying every value, on any number of partitions.

Gini gain decides. Every node that is not pure and has a valid split is split, also where the children
predict the same class. Equal gains take the earlier feature, then the smaller threshold. A threshold
lies half-way between the two values next to it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 256
#: Corners of a bin are listed up to this many classes; bins with more are always cut finer.
CORNER_CLASSES = 8
CLOSE = 1e-12


@dataclass
class Node:
    """Tests from the root (feature, threshold, op) and rows per class; children once it is split."""

    tests: list[tuple[str, float, str]]
    counts: np.ndarray
    children: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [leaf for c in self.children for leaf in c.leaves()] if self.children else [self]


def meets(tests: list[tuple[str, float, str]]) -> Column:
    """Whether a row passes all tests."""
    every = F.lit(True)
    for feature, threshold, op in tests:
        value = F.col(feature).cast("double")
        every = every & (value <= F.lit(threshold) if op == "<=" else value > F.lit(threshold))
    return every


def _gain(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What a split is compared by: sums of squared class counts over the rows of a side. Highest where
    the weighted impurity is lowest."""
    right = total - left
    n_left, n_right = left.sum(axis=-1), right.sum(axis=-1)
    return (left**2).sum(axis=-1) / np.maximum(n_left, 1) + (right**2).sum(axis=-1) / np.maximum(n_right, 1)


@dataclass
class _Bins:
    """The values of one feature inside one node: disjoint ranges in order, with their class counts."""

    low: np.ndarray
    high: np.ndarray
    counts: np.ndarray

    def refined(self, at: list[int], finer: list[_Bins]) -> _Bins:
        """With the given ranges replaced by finer ones."""
        given = dict(zip(at, finer))
        parts = [given.get(i) or _Bins(self.low[i : i + 1], self.high[i : i + 1], self.counts[i : i + 1]) for i in range(len(self.low))]
        return _Bins(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("low", "high", "counts")))

    def splits(self, min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gain, threshold, left counts) between neighbours; minus infinity where a side is too small."""
        total, left = self.counts.sum(axis=0), np.cumsum(self.counts, axis=0)[:-1]
        n_left = left.sum(axis=1)
        valid = (n_left >= min_leaf) & (total.sum() - n_left >= min_leaf)
        below, above = self.high[:-1], self.low[1:]
        middle = below + (above - below) / 2
        middle = np.where(middle >= above, below, middle)  # two values without one between them
        return np.where(valid, _gain(left, total), -np.inf), middle, left

    def open(self, best: float, min_leaf: int) -> list[int]:
        """Ranges that may hold a split at least as good inside."""
        total, after = self.counts.sum(axis=0), np.cumsum(self.counts, axis=0)
        n, k = total.sum(), len(total)
        found = []
        for i in np.flatnonzero(self.low < self.high):
            before = after[i] - self.counts[i]
            first, last = before.sum(), after[i].sum()
            if max(first + 1, min_leaf) > min(last - 1, n - min_leaf):
                continue
            present = np.flatnonzero(self.counts[i])
            if len(present) > CORNER_CLASSES:
                found.append(int(i))
                continue
            corners = np.array(list(product((0.0, 1.0), repeat=len(present))))
            ends = [min_leaf <= m <= n - min_leaf for m in (first, last)]  # these splits are known already
            corners = corners[int(ends[0]) : len(corners) - int(ends[1])]
            if not len(corners):
                continue
            left = np.repeat(before[None, :], len(corners), axis=0)
            left[:, present] += corners * self.counts[i, present]
            if _gain(left, total).max() >= best * (1 - CLOSE):
                found.append(int(i))
        return found


def _histogram(rows: DataFrame, features: list[str], classes: int, spans: list[tuple]) -> dict[int, _Bins]:
    """Bins of every span (number, node, feature, low, high) over rows with `_node` and `_class`."""
    cells = [F.struct(F.lit(f).alias("feature"), F.col(features[f]).cast("double").alias("value")) for f in sorted({s[2] for s in spans})]
    long = rows.where("_node is not null").select("_node", "_class", F.inline(F.array(*cells)))
    wanted = rows.sparkSession.createDataFrame(spans, "span int, _node int, feature int, low double, high double")
    inside = long.join(F.broadcast(wanted), ["_node", "feature"]).where("value between low and high")  # a few rows
    place = F.when(F.col("high") > F.col("low"), F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * BINS))
    bin_ = F.least(F.lit(BINS - 1), F.coalesce(place, F.lit(0))).cast("int")
    counted = inside.groupBy("span", bin_.alias("bin")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), *[F.count_if(F.col("_class") == c).alias(f"n{c}") for c in range(classes)]
    )
    found: dict[int, list] = {}
    for r in counted.collect():  # spans x bins
        found.setdefault(r["span"], []).append((r["bin"], r["low"], r["high"], *(r[f"n{c}"] for c in range(classes))))
    made = {s: np.array(sorted(b), dtype=float) for s, b in found.items()}
    return {s: _Bins(b[:, 1], b[:, 2], b[:, 3:]) for s, b in made.items()}


def _best(bins: list[_Bins], min_leaf: int) -> tuple[float, int, float, np.ndarray] | None:
    """(gain, feature, threshold, left counts) of a node's best split between ranges."""
    found = [b.splits(min_leaf) for b in bins]
    top = max((g.max() for g, _, _ in found if len(g)), default=-np.inf)
    if top == -np.inf:
        return None
    for feature, (gain, threshold, left) in enumerate(found):
        near = np.flatnonzero(gain >= top * (1 - CLOSE))
        if len(near):
            return top, feature, float(threshold[near[0]]), left[near[0]]
    return None


def _split_level(rows: DataFrame, features: list[str], nodes: list[Node], ranges: list[tuple[float, float]], min_leaf: int) -> None:
    """Give all nodes that have a valid split their children."""
    node = F.lit(None).cast("int")
    for i, n in enumerate(nodes):
        node = F.when(meets(n.tests), F.lit(i)).otherwise(node)
    placed = rows.select("*", node.alias("_node"))
    classes = len(nodes[0].counts)
    every = [(i, f) for i in range(len(nodes)) for f in range(len(features))]
    first = _histogram(placed, features, classes, [(s, i, f, *ranges[f]) for s, (i, f) in enumerate(every)])
    bins = {key: first[s] for s, key in enumerate(every)}
    while True:
        best = [_best([bins[i, f] for f in range(len(features))], min_leaf) for i in range(len(nodes))]
        open_ = {(i, f): b.open(best[i][0] if best[i] else -np.inf, min_leaf) for (i, f), b in bins.items()}
        spans = [(i, f, at) for (i, f), ats in open_.items() for at in ats]
        if not spans:
            break
        asked = [(s, i, f, float(bins[i, f].low[at]), float(bins[i, f].high[at])) for s, (i, f, at) in enumerate(spans)]
        finer = _histogram(placed, features, classes, asked)
        for key, ats in open_.items():
            if ats:
                bins[key] = bins[key].refined(ats, [finer[spans.index((*key, at))] for at in ats])
    for n, split in zip(nodes, best):
        if split:
            _, f, threshold, left = split
            for op, counts in (("<=", left), (">", n.counts - left)):
                n.children.append(Node([*n.tests, (features[f], threshold, op)], counts))


def grow(rows: DataFrame, features: list[str], label: str, max_depth: int, min_leaf: int) -> tuple[Node, list[int]]:
    """The root of a tree over rows without missing features, and the classes that counts are in order of."""
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(label).cast("int")).count().collect()}  # one row a class
    classes = sorted(sizes)
    root = Node([], np.array([float(sizes[c]) for c in classes]))
    if not classes:
        return root, classes
    ends = rows.agg(*[F.struct(F.min(F.col(f).cast("double")), F.max(F.col(f).cast("double"))) for f in features]).first()
    ranges = [tuple(e) for e in ends]
    class_ = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("int")) - 1
    slim = rows.select(*features, class_.cast("int").alias("_class"))
    level = [root]
    for _ in range(max_depth):
        level = [n for n in level if (n.counts > 0).sum() > 1 and n.counts.sum() >= 2 * min_leaf]
        if not level:
            break
        _split_level(slim, features, level, ranges, min_leaf)
        level = [c for n in level for c in n.children]
    return root, classes
