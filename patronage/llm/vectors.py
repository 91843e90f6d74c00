"""Vectors of numbers: which ones count, as matrices in tasks, and centres chosen from a sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def width(df: DataFrame, vector: str) -> int:
    """Components of the longest vector; shorter ones count as ending in zeros."""
    return df.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(lists: pa.Array | pa.ChunkedArray, dims: int, kind=np.float64) -> np.ndarray:
    """A list column as rows of a matrix, short lists filled up with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    if (size == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(size), dims), kind)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances, rows by centres."""
    squares = (rows**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * rows @ centres.T
    return np.sqrt(np.maximum(squares, 0))


def farthest_first(rows: np.ndarray, most: int) -> np.ndarray:
    """Row numbers of centres: each one the row farthest from those before it."""
    chosen, near = [0], distances(rows, rows[:1])[:, 0]
    while len(chosen) < most and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(rows, rows[chosen[-1:]])[:, 0])
    return np.array(chosen)
