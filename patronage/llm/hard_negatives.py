"""Hard negatives by Kronecker-packed products.

Vectors are compared as whole numbers floor(scale * x). In a tile of candidates every component is
biased so that it isn't negative, and the components of several candidates stand in separated fields of
one wide integer, each field as many bits as the largest possible score needs:

    packed[d] = sum over j of (b[j, d] - least) << (bits * j)

An anchor multiplies each packed integer once per component and adds up; its exact scores with all of
the candidates are then the fields of the sum, less what the biases added. Fields are packed into 64
bits; scores that need more bits than that go through whole numbers of any length.

Two rounds of tiles. First an anchor meets the rows of its own label, in tiles within the label, which
gives its positives. Then it meets the tiles of all rows, and of each tile it takes the best rows of
other labels inside each positive's window. A tile returns a few rows for each anchor and positive, so
the merge shuffles little; a label that holds a third of all rows is just more tiles. The stated anchors
against all rows are the work: it grows with their product.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no
part; rows equal in id, label and vector count once; "other" rows have another id; rows that share an
id but not their label or vector are anchors each for itself; shorter vectors count as ending in zeros;
components beyond 64 bits saturate; fewer candidates give fewer rows, and an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.vectors import matrix, usable, width
from patronage.session import cut_lineage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 80, 100
BLOCK = 8192
ANCHOR_BLOCK = 8192
#: Anchors that are multiplied at once.
STRIP = 128
#: Bits of a packed number, and the most that a score may need in it: a hundred times as much still fits.
WORD, SCORE = 64, 56
#: Fields of a packed number that doesn't fit a machine word.
LONG_FIELDS = 8


class Packed:
    """Candidates whose components are packed for anchors within given bounds."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        self.n, self.dims = rows.shape
        self.least, self.anchor_least = int(rows.min(initial=0)), int(anchors.min(initial=0))
        most = (int(rows.max(initial=0)) - self.least) * (int(anchors.max(initial=0)) - self.anchor_least)
        self.bits = max(1, (most * max(self.dims, 1)).bit_length())
        largest = int(np.abs(rows).max(initial=0)) * int(np.abs(anchors).max(initial=0)) * max(self.dims, 1)
        fits = max(self.bits, largest.bit_length()) <= SCORE
        self.kind, self.fields = (np.uint64, WORD // self.bits) if fits else (object, LONG_FIELDS)
        shifted = self._shifted(rows, self.least)
        self.sums = shifted.sum(axis=1)
        groups = -(-self.n // self.fields)
        self.packed = np.zeros((self.dims, groups), self.kind)
        for j in range(self.fields):
            own = shifted[j :: self.fields].T
            self.packed[:, : own.shape[1]] += own << self.kind(self.bits * j) if self.kind is np.uint64 else own << self.bits * j

    def _shifted(self, rows: np.ndarray, least: int) -> np.ndarray:
        if self.kind is object:
            return rows.astype(object) - least
        return (rows - least).astype(np.uint64)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors by candidates."""
        shifted = self._shifted(anchors, self.anchor_least)
        if self.kind is object:
            sums, mask = shifted @ self.packed, (1 << self.bits) - 1
            out, whole = np.zeros((len(anchors), self.n), object), object
        else:
            sums = np.einsum("ad,dg->ag", shifted, self.packed)
            mask, whole = np.uint64(2**self.bits - 1), np.int64
            out = np.zeros((len(anchors), self.n), np.int64)
        for j in range(self.fields):
            field = sums >> (self.bits * j if whole is object else np.uint64(self.bits * j)) & mask
            own = out[:, j :: self.fields]
            own[:] = field[:, : own.shape[1]].astype(whole)
        biases = self.dims * self.least * self.anchor_least
        out += (self.least * shifted.sum(axis=1).astype(whole))[:, None] + biases
        out += (self.anchor_least * self.sums.astype(whole))[None, :]
        return out


def _first(anchor: np.ndarray, score: np.ndarray, vec: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first `most` of each anchor: higher scores, then smaller ids."""
    order = np.lexsort((vec, -score, anchor))
    sorted_ = anchor[order]
    begin = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])[: len(order)])
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[rank < most]


def _longs(values: np.ndarray) -> np.ndarray:
    """Scores of a tile as 64-bit numbers."""
    if values.dtype == object:
        info = np.iinfo(np.int64)
        return np.clip(values, info.min, info.max).astype(np.int64)
    return values


POSITIVE = "node long, anchor_id long, vec_id long, score long"
NEGATIVE = "node long, anchor_id long, positive int, positive_id long, positive_score long, vec_id long, score long"


def _strips(anchors: pa.Table, data: pa.Table, dims: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows of anchors, scores, whether the candidate is another row) strip by strip."""
    asked, rows = matrix(anchors["v"], dims, np.int64), matrix(data["v"], dims, np.int64)
    packed = Packed(rows, asked)
    own, ids = anchors["vec_id"].to_numpy(), data["vec_id"].to_numpy()
    for i in range(0, len(asked), STRIP):
        strip = slice(i, i + STRIP)
        yield strip, packed.scores(asked[strip]), own[strip][:, None] != ids[None, :]


def _positives_of_tile(dims: int, most: int):
    kind = pa.schema([(n, pa.int64()) for n in ("node", "anchor_id", "vec_id", "score")])

    def run(anchors: pa.Table, data: pa.Table) -> pa.Table:
        out = [kind.empty_table()]
        if anchors.num_rows and data.num_rows:
            node, own, ids = anchors["node"].to_numpy(), anchors["vec_id"].to_numpy(), data["vec_id"].to_numpy()
            for strip, scores, other in _strips(anchors, data, dims):
                a, c = np.nonzero(other)
                if scores.shape[1] > 4 * most:  # look at no more than can be among the first ones
                    scores = _longs(scores)
                    ranked = np.where(other, scores, np.iinfo(np.int64).min)
                    least = np.partition(ranked, -most, axis=1)[:, -most]
                    a, c = np.nonzero(other & (scores >= least[:, None]))
                found = _longs(scores[a, c])
                at = _first(a, found, ids[c], most)
                a, c = a[at], c[at]
                columns = [node[strip][a], own[strip][a], ids[c], found[at]]
                out.append(pa.table([pa.array(x) for x in columns], schema=kind))
        return pa.concat_tables(out)

    return run


def _negatives_of_tile(dims: int, most: int, low: int, high: int):
    names = ("node", "anchor_id", "positive", "positive_id", "positive_score", "vec_id", "score")
    kind = pa.schema([(n, pa.int32() if n == "positive" else pa.int64()) for n in names])

    def run(anchors: pa.Table, data: pa.Table) -> pa.Table:
        out = [kind.empty_table()]
        if anchors.num_rows and data.num_rows:
            node, own, label = (anchors[n].to_numpy() for n in ("node", "vec_id", "label"))
            ids, labels = data["vec_id"].to_numpy(), data["label"].to_numpy()
            lists = anchors["positives"].combine_chunks()
            begin, size = lists.offsets.to_numpy()[:-1], np.diff(lists.offsets.to_numpy())
            flat = lists.values  # ordered as the positives are
            positive_ids, positive_scores = (flat.field(n).to_numpy() for n in ("vec_id", "score"))
            for strip, scores, other in _strips(anchors, data, dims):
                other &= label[strip][:, None] != labels[None, :]
                for p in range(int(size[strip].max(initial=0))):
                    have = np.flatnonzero(size[strip] > p)
                    at = begin[strip][have] + p
                    score = positive_scores[at].astype(scores.dtype)[:, None]
                    some = scores[have]
                    inside = (some <= score) if high == 100 else (100 * some <= high * score)
                    inside &= (low * score <= 100 * some) & other[have]
                    a, c = np.nonzero(inside)
                    found = _longs(some[a, c])
                    best = _first(a, found, ids[c], most)
                    a, c = a[best], c[best]
                    columns = [node[strip][have[a]], own[strip][have[a]], np.full(len(a), p, np.int32)]
                    columns += [positive_ids[at[a]], positive_scores[at[a]], ids[c], found[best]]
                    out.append(pa.table([pa.array(x) for x in columns], schema=kind))
        return pa.concat_tables(out)

    return run


def _rows(vectors: DataFrame, label: Column, vector: str, scale: int) -> DataFrame:
    """(node, vec_id, label, v) with v in whole numbers: each different row that takes part, numbered."""
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("v")
    )
    given = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return given.select("vec_id", "label", whole.alias("v")).distinct().withColumn("node", F.monotonically_increasing_id())


def _tiles(n: Column | str, size: int) -> Column:
    return F.ceil(F.col(n) / size).cast("int")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). `is_anchor` is a
    condition on vec_id; `label` defaults to the column of that name."""
    rows = cut_lineage(_rows(vectors, F.col("label") if label is None else label, vector, scale))
    dims = max(width(rows, "v"), 1)  # vectors may all be empty
    anchors = cut_lineage(rows.where(is_anchor))

    # own label: tiles within the label, as many as its rows and anchors need
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("asked"))
    sizes = cut_lineage(
        sizes.where("asked > 0").select("label", _tiles("n", BLOCK).alias("blocks"), _tiles("asked", ANCHOR_BLOCK).alias("parts"))
    )
    dealt = F.xxhash64("node")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asked = anchors.join(sizes, "label").select(
        "label", F.pmod(dealt, "parts").cast("int").alias("part"), every("blocks").alias("block"), "node", "vec_id", "v"
    )
    held = rows.join(sizes, "label").select(
        "label", F.pmod(dealt, "blocks").cast("int").alias("block"), every("parts").alias("part"), "vec_id", "v"
    )
    keys = ["label", "part", "block"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_positives_of_tile(dims, positives), POSITIVE)
    best = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    listed = found.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    anchors = cut_lineage(anchors.join(listed, "node"))  # `positives` holds a few entries at most

    # all rows: tiles by number
    blocks, parts = (max(1, -(-df.count() // size)) for df, size in ((rows, BLOCK), (anchors, ANCHOR_BLOCK)))
    counts = {"blocks": F.lit(blocks), "parts": F.lit(parts)}
    asked = anchors.withColumns(counts).select(
        F.pmod(dealt, "parts").cast("int").alias("part"), every("blocks").alias("block"), "node", "vec_id", "label", "v", "positives"
    )
    held = rows.withColumns(counts).select(
        F.pmod(dealt, "blocks").cast("int").alias("block"), every("parts").alias("part"), "vec_id", "label", "v"
    )
    keys = ["part", "block"]
    tile = _negatives_of_tile(dims, negatives, low, high)
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(tile, NEGATIVE)
    best = Window.partitionBy("node", "positive").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
