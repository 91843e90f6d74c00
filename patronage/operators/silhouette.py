"""Mean silhouette of several labellings of the same weighted points.

A point stands for ``weight`` equal rows, so all measures give what the single rows would give.

* ``sampled``: plain distances of a sample of points to all points. Scores of the sampled points are
  exact, so the mean has a known error; the sample doubles until the best labelling is told from the
  others, and ends as all points if that takes them. A task reduces its points to sums for each
  sampled point and cluster, so work and shuffle are linear in the points.

* ``euclidean``: plain distances, which need every pair of distinct points. Points are dealt into
  tiles by hash; each pair of tiles is one task that keeps a running sum per point and cluster, so
  no pair of points is ever a row. Work is quadratic in the distinct points.
* ``squared``: squared distances, for which the mean distance to a cluster follows from the
  cluster's count, vector sum and sum of squared norms. Two linear passes at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .kmeans import weighted_sample

TILE_POINTS = 8192
CHUNK_POINTS = 1024


def cluster_sizes(points: DataFrame, labels: list[str], weight: str) -> dict[str, dict[int, int]]:
    """Rows per label of each labelling: a few numbers per labelling."""
    sides = [F.struct(F.lit(name).alias("run"), F.col(name).cast("int").alias("label")) for name in labels]
    long = points.select(F.col(weight).alias("w"), F.inline(F.array(*sides)))
    sizes: dict[str, dict[int, int]] = {name: {} for name in labels}
    for row in long.groupBy("run", "label").agg(F.sum("w").alias("n")).collect():
        sizes[row["run"]][row["label"]] = row["n"]
    return sizes


def _mean_of(per_point: DataFrame, sizes: dict[str, dict[int, int]]) -> dict[str, float]:
    """Weighted mean per labelling; -1 for a labelling with a single label."""
    row = per_point.agg(*[(F.sum(F.col("w") * F.col(n)) / F.sum("w")).alias(n) for n in sizes]).first()
    return {n: float(row[n]) if len(sizes[n]) > 1 else -1.0 for n in sizes}


def _scorer():
    """The per-task scoring function. Made inside a function, so that it travels to the executors by
    value and they need no copy of this package."""

    def scores(own: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Silhouette per point from its distance sums to each cluster (points x clusters)."""
        rows = np.arange(len(labels))
        inside = own[rows, labels] / np.maximum(counts[labels] - 1, 1)
        means = own / counts
        means[rows, labels] = np.inf
        outside = means.min(axis=1)
        largest = np.maximum(inside, outside)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(largest > 0, (outside - inside) / largest, 0.0)
        return np.where(counts[labels] == 1, 0.0, score)

    return scores


def _layout(sizes: dict[str, dict[int, int]]) -> dict[str, tuple[list[int], np.ndarray]]:
    """Per labelling its sorted labels and their row counts."""
    return {n: (sorted(s), np.array([s[c] for c in sorted(s)], dtype=float)) for n, s in sizes.items()}


def euclidean(
    points: DataFrame, id_col: str, dims: list[str], labels: list[str], weight: str, tile_points: int = TILE_POINTS
) -> dict[str, float]:
    """Exact mean silhouette per labelling with plain distances."""
    sizes = cluster_sizes(points, labels, weight)
    layout = _layout(sizes)
    total = points.count()
    # a few tile pairs per task slot, and never a tile beyond the set size
    slots = points.sparkSession.sparkContext.defaultParallelism
    tiles = max(-(-total // tile_points), int(np.ceil(np.sqrt(4 * slots))))
    sums = [f"d_{n}_{c}" for n in labels for c in layout[n][0]]

    base = points.select(
        F.col(id_col).alias("id"),
        F.col(weight).cast("double").alias("w"),
        *[F.col(d).cast("double").alias(f"x{i}") for i, d in enumerate(dims)],
        *[F.col(n).cast("int").alias(n) for n in labels],
        # an int like the generated tile numbers: both sides of a cogroup must hash their keys alike
        F.pmod(F.xxhash64(id_col), F.lit(tiles)).cast("int").alias("tile"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    left = base.withColumn("other", every).withColumnsRenamed({"tile": "a", "other": "b"})
    right = base.withColumn("other", every).withColumnsRenamed({"tile": "b", "other": "a"})
    coordinates = [f"x{i}" for i in range(len(dims))]
    chunk_points, scores = CHUNK_POINTS, _scorer()

    def tile_pair(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        x, y = mine[coordinates].to_numpy(), theirs[coordinates].to_numpy()
        my_ids, their_ids = mine["id"].to_numpy(), theirs["id"].to_numpy()
        one_tile = len(mine) > 0 and mine["a"].iloc[0] == mine["b"].iloc[0]
        member = np.concatenate(
            [
                (theirs[n].to_numpy()[:, None] == np.array(layout[n][0])[None, :]) * theirs["w"].to_numpy()[:, None]
                for n in labels
            ],
            axis=1,
        )
        y_norm = (y * y).sum(axis=1)
        parts = []
        for start in range(0, len(x), chunk_points):
            chunk = x[start : start + chunk_points]
            squared = (chunk * chunk).sum(axis=1)[:, None] + y_norm[None, :] - 2.0 * (chunk @ y.T)
            distance = np.sqrt(np.maximum(squared, 0.0))
            if one_tile:
                distance[my_ids[start : start + chunk_points, None] == their_ids[None, :]] = 0.0
            parts.append(distance @ member)
        out = mine[["id", "w", *labels]].reset_index(drop=True)
        near = np.concatenate(parts) if parts else np.zeros((0, len(sums)))
        return pd.concat([out, pd.DataFrame(near, columns=sums)], axis=1)

    head = "id long, w double, " + ", ".join(f"{n} int" for n in labels)
    schema = head + ", " + ", ".join(f"{s} double" for s in sums)
    partial = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(tile_pair, schema)
    whole = partial.groupBy("id", "w", *labels).agg(*[F.sum(s).alias(s) for s in sums])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"w": batch["w"]}
            for n in labels:
                known, counts = layout[n]
                if len(known) < 2:
                    out[n] = np.zeros(len(batch))
                    continue
                own = batch[[f"d_{n}_{c}" for c in known]].to_numpy().copy()
                out[n] = scores(own, np.searchsorted(known, batch[n].to_numpy()), counts)
            yield pd.DataFrame(out)

    scored = whole.mapInPandas(score, "w double, " + ", ".join(f"{n} double" for n in labels))
    return _mean_of(scored, sizes)


#: Points of the first sample, and of a block that is compared with all points at once.
SAMPLED = 2048
#: Standard errors that tell two labellings apart, and a difference that need not be told.
ERRORS, MARGIN = 4.0, 0.002


def _distance_sums(points: DataFrame, some: np.ndarray, dims: list[str], layout: dict, weight: str) -> np.ndarray:
    """Weighted sums of distances, sampled points by clusters of all labellings, exact to a fixed unit so
    that the order of rows doesn't matter."""
    labels = list(layout)
    wide = sum(len(layout[n][0]) for n in labels)
    norms, unit = (some**2).sum(axis=1), 2.0**-20

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(some), wide), np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK_POINTS):
                part = batch.slice(begin, CHUNK_POINTS)
                x = np.stack([part.column(d).to_numpy() for d in dims], axis=1)
                w = part.column(weight).to_numpy()
                far = norms[:, None] + (x**2).sum(axis=1)[None, :] - 2.0 * some @ x.T
                whole = np.rint(np.sqrt(np.maximum(far, 0.0)) / unit)
                member = np.concatenate(
                    [(part.column(n).to_numpy()[:, None] == np.array(layout[n][0])[None, :]) * w[:, None] for n in labels], axis=1
                )
                total += (whole @ member.astype(float)).astype(np.int64)
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(total[at].tolist(), pa.list_(pa.int64()))], ["at", "sums"]
        )

    parts = points.select(weight, *dims, *labels).mapInArrow(run, "at int, sums array<long>")
    added = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(wide)]
    out = np.zeros((len(some), wide))
    for row in parts.groupBy("at").agg(*added).collect():  # one row a sampled point
        out[row["at"]] = [float(v) for v in list(row)[1:]]
    return out * unit


def sampled(
    points: DataFrame, dims: list[str], labels: list[str], weight: str, key: str, first: int = SAMPLED
) -> dict[str, float]:
    """Mean silhouette per labelling with plain distances. ``key`` is the sample key of each point.

    The sample stops growing once `ERRORS` standard errors are within `MARGIN`: at some hundred
    thousand points, whatever their number.
    """
    sizes = cluster_sizes(points, labels, weight)
    layout, score = _layout(sizes), _scorer()
    slim = points.select(weight, key, *dims, *[F.col(n).cast("int").alias(n) for n in labels])
    known = {n: np.empty(0) for n in labels}
    most = first
    while True:
        rows, chance = weighted_sample(slim, weight, key, most)
        fresh = rows[len(known[labels[0]]) :]  # smaller samples are the beginnings of larger ones
        for begin in range(0, len(fresh), SAMPLED):
            block = fresh[begin : begin + SAMPLED]
            x = np.array([[r[d] for d in dims] for r in block], dtype=float)
            sums, at = _distance_sums(slim, x, dims, layout, weight), 0
            for n in labels:
                clusters, counts = layout[n]
                own, at = sums[:, at : at + len(clusters)], at + len(clusters)
                label = np.searchsorted(clusters, [r[n] for r in block])
                values = score(own, label, counts) if len(clusters) > 1 else np.full(len(block), -1.0)
                known[n] = np.concatenate([known[n], values])
        share = np.array([r[weight] for r in rows], dtype=float) / chance
        means = {n: float((share * known[n]).sum() / share.sum()) if len(rows) else -1.0 for n in labels}
        best = max(labels, key=lambda n: means[n])

        def open_(n: str) -> bool:
            gap = known[best] - known[n]
            error = np.sqrt(((1 - chance) * (share * (gap - means[best] + means[n])) ** 2).sum()) / share.sum()
            return MARGIN < ERRORS * error and means[best] - means[n] < ERRORS * error

        if (chance == 1).all() or not any(open_(n) for n in labels if n != best):
            return means
        most *= 2


def squared(points: DataFrame, dims: list[str], labels: list[str], weight: str) -> dict[str, float]:
    """Exact mean silhouette per labelling with squared distances, in linear time."""
    sizes = cluster_sizes(points, labels, weight)
    layout = _layout(sizes)
    w = F.col(weight).cast("double")
    sides = [F.struct(F.lit(n).alias("run"), F.col(n).cast("int").alias("label")) for n in labels]
    base = points.select(w.alias("w"), *[F.col(d).cast("double").alias(d) for d in dims], *labels)
    norm = sum((F.col(d) * F.col(d) for d in dims[1:]), F.col(dims[0]) * F.col(dims[0]))
    long = base.select("w", *dims, norm.alias("_norm"), F.inline(F.array(*sides)))
    moments = long.groupBy("run", "label").agg(
        F.sum(F.col("w") * F.col("_norm")).alias("_norm"), *[F.sum(F.col("w") * F.col(d)).alias(d) for d in dims]
    )
    # a count, a norm and a vector per cluster
    per_cluster = {(r["run"], r["label"]): r for r in moments.collect()}
    norms = {n: np.array([per_cluster[n, c]["_norm"] for c in layout[n][0]]) for n in labels}
    scores = _scorer()
    vectors = {n: np.array([[per_cluster[n, c][d] for d in dims] for c in layout[n][0]]) for n in labels}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[dims].to_numpy()
            x_norm = (x * x).sum(axis=1)
            out = {"w": batch["w"]}
            for n in labels:
                known, counts = layout[n]
                if len(known) < 2:
                    out[n] = np.zeros(len(batch))
                    continue
                own = np.maximum(x_norm[:, None] * counts + norms[n] - 2.0 * (x @ vectors[n].T), 0.0)
                out[n] = scores(own, np.searchsorted(known, batch[n].to_numpy()), counts)
            yield pd.DataFrame(out)

    scored = base.mapInPandas(score, "w double, " + ", ".join(f"{n} double" for n in labels))
    return _mean_of(scored, sizes)


def numbered(points: DataFrame, id_col: str) -> DataFrame:
    """Points with an id that stays the same over later jobs, because the rows are written once."""
    return cut_lineage(points.withColumn(id_col, F.monotonically_increasing_id()))
