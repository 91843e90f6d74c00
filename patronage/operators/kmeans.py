"""Weighted k-means for several k and several starts at once, the same on any number of partitions.

Points lie on a grid of whole numbers, so the sums of a round are exact in any order. Starts come from a
sample with exponential keys: a point's key is -ln(u) / weight with u a hash of its values, and the
points with the smallest keys are a sample by weight that no partitioning changes. The driver spreads
the first centres over that sample, farther points more likely, and lets each start settle on it; it
holds only the sample and the centres. The best start of every k goes on over all points. A round of all
fits that still move is one job: tasks reduce their points to sums per fit and centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID_BITS = 20
SAMPLE = 4096
STARTS = 4
ROUNDS = 300
TOLERANCE = 1e-4


def sample_key(weight: str, columns: list[str], seed: int) -> Column:
    """Exponential key of a weighted point by its values."""
    u = (F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11) + 1) / F.lit(2.0**53)
    return -F.ln(u) / F.col(weight).cast("double")


def weighted_sample(points: DataFrame, weight: str, key: str, most: int) -> tuple[list, np.ndarray]:
    """(rows with the smallest keys, the chance of each to be among them). `most` rows reach the driver;
    if there are no more, all are certain."""
    rows = points.orderBy(key).limit(most + 1).collect()
    if len(rows) <= most:
        return rows, np.ones(len(rows))
    last = rows.pop()[key]
    return rows, -np.expm1(-np.array([r[weight] for r in rows], dtype=float) * last)


@dataclass(frozen=True)
class Fit:
    """Centres in grid units, rows nearest to each, and the sum of squared distances."""

    centers: np.ndarray
    sizes: np.ndarray
    inertia: float


def _spread(x: np.ndarray, weight: np.ndarray, k: int, seed: list[int]) -> np.ndarray:
    """First centres out of a sample: each one by weight times squared distance to those before it."""
    rng = np.random.default_rng(seed)
    chosen = [int(np.searchsorted(np.cumsum(weight), rng.random() * weight.sum()))]
    near = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(x)):
        share = np.cumsum(weight * near)
        if share[-1] > 0:
            at = int(np.searchsorted(share, rng.random() * share[-1], side="right"))
        else:
            at = next(i for i in range(len(x)) if i not in chosen)
        chosen.append(min(at, len(x) - 1))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _settle(x: np.ndarray, weight: np.ndarray, centers: np.ndarray) -> tuple[float, np.ndarray]:
    """(inertia, centres) of a start after rounds over the sample alone."""
    for _ in range(ROUNDS):
        far = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
        label = far.argmin(axis=1)
        n = np.bincount(label, weights=weight, minlength=len(centers))
        sums = np.stack([np.bincount(label, weights=weight * c, minlength=len(centers)) for c in x.T], axis=1)
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1e-300)[:, None], centers)
        step = ((moved - centers) ** 2).sum()
        centers = moved
        if step <= TOLERANCE * 4.0**GRID_BITS:
            break
    return float((weight * far.min(axis=1)).sum()), centers


def _sums(points: DataFrame, centers: list[np.ndarray], weight: str) -> dict[tuple[int, int], tuple[int, list[int], int]]:
    """Per fit and centre: rows, sums of the points, and squared distances in parts of a grid's square."""
    dims = centers[0].shape[1]
    low_bits, shift = (1 << GRID_BITS) - 1, GRID_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(c), 2 * dims + 2), np.int64) for c in centers]
        for batch in batches:
            w = batch.column(weight).to_numpy()
            whole = batch.column("x").flatten().to_numpy().reshape(-1, dims)
            x = whole.astype(np.float64)
            # two halves, so that weights can't overflow the sums
            parts = np.concatenate([whole >> shift, whole & low_bits], axis=1) * w[:, None]
            for c, total in zip(centers, totals):
                far = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
                label = far.argmin(axis=1)
                near = np.rint(far[np.arange(len(x)), label] / (1 << shift)).astype(np.int64) * w
                np.add.at(total, label, np.concatenate([parts, near[:, None], w[:, None]], axis=1))
        rows = [(f, j, t.tolist()) for f, total in enumerate(totals) for j, t in enumerate(total) if t[-1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32())]
            + [pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
            ["fit", "label", "totals"],
        )

    parts = points.select(weight, "x").mapInArrow(run, "fit int, label int, totals array<long>")
    added = [F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(2 * dims + 2)]
    out = {}
    for row in parts.groupBy("fit", "label").agg(*added).collect():  # fits x centres
        t = list(row)[2:]
        out[row["fit"], row["label"]] = (t[-1], [(t[i] << shift) + t[dims + i] for i in range(dims)], t[-2])
    return out


def fit_all(points: DataFrame, k_list: tuple[int, ...], weight: str, key: str, seed: int, starts: int = STARTS) -> dict[int, Fit]:
    """The fit of every k from its best start on the sample, the earlier one of equals.

    ``points`` has the weight, the sample key and `x`, the point in grid units. It is read once a round,
    so it should be cached or written. With fewer points than k there are fewer centres.
    """
    rows, chance = weighted_sample(points, weight, key, SAMPLE)
    if not rows:
        raise ValueError("no rows to fit")
    x = np.array([r["x"] for r in rows], dtype=float)
    heavy = np.array([r[weight] for r in rows], dtype=float) / chance
    names = list(k_list)
    settled = {k: [_settle(x, heavy, _spread(x, heavy, k, [seed, k, s])) for s in range(starts)] for k in names}
    centers = {k: min(found, key=lambda f: f[0])[1] for k, found in settled.items()}
    moving, done = {n: 0 for n in names}, {}
    tolerance = TOLERANCE * 4.0**GRID_BITS
    while moving:
        asked = list(moving)
        found = _sums(points, [centers[n] for n in asked], weight)
        for f, n in enumerate(asked):
            sums = [found.get((f, j)) for j in range(len(centers[n]))]
            moved = np.array([[v / s[0] for v in s[1]] if s else c for s, c in zip(sums, centers[n].tolist())])
            moving[n] += 1
            # the round before ended with a small step: these are the numbers of the centres it ended with
            if moving[n] < 0 or moving[n] > ROUNDS or (moved == centers[n]).all():
                sizes = np.array([s[0] if s else 0 for s in sums])
                done[n] = Fit(centers[n], sizes, sum(s[2] for s in sums if s) / 2.0**GRID_BITS)
                del moving[n]
                continue
            if ((moved - centers[n]) ** 2).sum() <= tolerance:
                moving[n] = -2
            centers[n] = moved
    return done
