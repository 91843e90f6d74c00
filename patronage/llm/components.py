"""Connected components of links, as Spark jobs over contracted stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.session import cut_lineage

LINKS = "a long, b long"
#: Links that a task holds before it reduces them to stars.
HELD = 1_000_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one link for each node but the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        before = label.copy()
        for side in (label[left], label[right], left, right):
            np.minimum.at(label, side, least)
        while not np.array_equal(up := label[label], label):
            label = up
        if np.array_equal(before, label):
            break
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


class LinkBuffer:
    """Links found by one task, kept as stars once there are many."""

    def __init__(self):
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._held, self._limit = 0, HELD

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if not len(a):
            return
        self._parts.append((a, b))
        self._held += len(a)
        if self._held > self._limit:
            self._reduce()
            self._limit = max(HELD, 2 * self._held)

    def _reduce(self) -> None:
        a, b = stars(*(np.concatenate(side) for side in zip(*self._parts)))
        self._parts, self._held = [(a, b)], len(a)

    def batches(self, size: int = 50_000) -> Iterator[pa.RecordBatch]:
        if not self._parts:
            return
        self._reduce()
        a, b = self._parts[0]
        for i in range(0, len(a), size):
            yield pa.RecordBatch.from_arrays([pa.array(a[i : i + size]), pa.array(b[i : i + size])], ["a", "b"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = LinkBuffer()
    for batch in batches:
        held.add(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")))
    yield from held.batches()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends, and goes
    on with the links between different ends. Hot nodes only stand on the side of a join that Spark
    can split, or under an aggregate that combines first. Tables between the rounds are written, so
    a lost executor costs one round at most.
    """
    links = cut_lineage(links.select("a", "b").where("a <> b").mapInArrow(_contract, LINKS))
    nodes = None
    while links.head(1):
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        hooks = _ends(cut_lineage(hooks.withColumn("to", F.least("node", "to"))))
        if nodes is None:
            nodes = hooks.select("node", F.col("to").alias("component"))
        else:
            nodes = cut_lineage(_moved(nodes, "component", hooks))
        links = _moved(_moved(links, "a", hooks), "b", hooks).where("a <> b")
        links = cut_lineage(links.mapInArrow(_contract, LINKS))
    if nodes is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes


def _moved(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """The frame with a column of nodes replaced by where their hooks lead."""
    to = hooks.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
    joined = df.join(to, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_to", column)).select(df.columns)


def _ends(hooks: DataFrame) -> DataFrame:
    """Hooks that lead to the end of their chain, by doubling. The end of a chain hooks to itself."""
    while True:
        moved = hooks.withColumn("was", F.col("to"))
        moved = cut_lineage(_moved(moved, "to", hooks))
        hooks = moved.select("node", "to")
        if not moved.where("`to` <> was").head(1):
            return hooks
