"""Embedding near-duplicates: all pairs by int8 tile products with rigorous error bounds.

Equal vectors become one with a number of copies. Each distinct vector belongs to the cell of its
nearest centre (centres: farthest-first over a sample of at most `SAMPLE` vectors), and a cell to
tiles of about `TILE` vectors. Two cells whose centres are farther apart than their radii and the
threshold's angle together can't hold a link and never meet; all other pairs of tiles do. Where the
cells exclude so little that dealing vectors to them makes more copies than tiles of all vectors, as
with vectors that don't cluster, there is one cell.

In a pair of tiles every unit vector x is scale * q + rest with q in whole numbers from -127 to 127.
The products of the q are exact. A pair's cosine is at most
scale_x scale_y q_x.q_y + |x - rest_x| |rest_y| + |rest_x| |y - rest_y| + |rest_x| |rest_y|;
only pairs that this lets reach the threshold are computed again, in double precision. A tile pair
returns sums and stars for its vectors, never the pairs.

The work is that of all pairs that the cells can't exclude: quadratic where vectors don't cluster.

Defined results: vectors that are null, zero or hold null or non-finite components link with nothing;
shorter vectors count as ending in zeros; rows with a null vec_id count as links of others but name no
component, and aren't kept; repeated rows are copies that link; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.components import LinkBuffer, components
from patronage.llm.vectors import distances, farthest_first, matrix, usable, width
from patronage.session import cut_lineage

COSINE = 0.95
TILE = 4096
CELLS = 32
SAMPLE = 2048
#: Rows of a tile that are multiplied at once.
STRIP = 512
#: Allowance for rounding in bounds that are computed in floating point.
ROUNDING = 1e-5


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # first, so that no square overflows
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def _distinct(rows: DataFrame) -> DataFrame:
    """(node, least, copies, vector) of every different vector that can link."""
    some = rows.where(usable(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    grouped = some.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    return cut_lineage(grouped.withColumn("node", F.monotonically_increasing_id()))


def _centres(distinct: DataFrame, dims: int, cells: int) -> np.ndarray:
    sample = distinct.orderBy(F.xxhash64("vector"), "node").limit(SAMPLE).select("vector").toArrow()
    rows = _unit(matrix(sample["vector"], dims)) if sample.num_rows else np.zeros((0, dims))
    return rows[farthest_first(rows, cells)] if len(rows) else rows


def _in_cells(distinct: DataFrame, dims: int, centres: np.ndarray) -> DataFrame:
    def assign(batches):
        for batch in batches:
            rows = _unit(matrix(batch.column("vector"), dims))
            far = distances(rows, centres)
            cell = far.argmin(axis=1)
            columns = [batch.column(c) for c in ("node", "copies", "vector")]
            radius = pa.array(far[np.arange(len(cell)), cell])
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cell, pa.int32()), radius], ["node", "copies", "vector", "cell", "far"]
            )

    kind = dict(distinct.dtypes)["vector"]
    return distinct.select("node", "copies", "vector").mapInArrow(
        assign, f"node long, copies long, vector {kind}, cell int, far double"
    )


def _meetings(stats: list, centres: np.ndarray, cosine: float, tile: int) -> list[tuple[int, int, int, int]]:
    """(cell, its tiles, other cell, its tiles) of the cells that may hold links; at most cells ** 2."""
    angle = lambda chord: 2 * np.arcsin(np.minimum(chord / 2, 1))
    between = angle(distances(centres, centres))
    reach = {r["cell"]: float(angle(r["far"])) for r in stats}
    tiles = {r["cell"]: -(-r["n"] // tile) for r in stats}
    limit = math.acos(cosine) + ROUNDING
    return [
        (a, tiles[a], b, tiles[b])
        for a in tiles
        for b in tiles
        if between[a, b] - reach[a] - reach[b] <= limit
    ]


def _copies(stats: list, meetings: list[tuple[int, int, int, int]]) -> int:
    """How many rows the vectors become that are dealt to these meetings."""
    of = {r["cell"]: r["n"] for r in stats}
    return sum(of[a] * tiles for a, _, _, tiles in meetings)


def _dealt(placed: DataFrame, meetings: list) -> DataFrame:
    """Every vector once for each pair of tiles that its tile is in; side 0 is the smaller tile."""
    spark = placed.sparkSession
    other = spark.createDataFrame(meetings, "cell int, own_tiles int, other int, other_tiles int")
    met = placed.join(other, "cell")
    met = met.withColumn("tile", F.pmod(F.xxhash64("node"), "own_tiles").cast("int"))
    met = met.withColumn("other_tile", F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1)))
    own, facing = F.struct("cell", "tile"), F.struct(F.col("other").alias("cell"), F.col("other_tile").alias("tile"))
    return met.select(
        "node", "copies", "vector",
        F.least(own, facing).alias("first"), F.greatest(own, facing).alias("second"),
        F.when(own == facing, 2).when(own < facing, 0).otherwise(1).alias("side"),
    )


class _Tile:
    """Unit vectors of a tile, quantised."""

    def __init__(self, rows: pa.Table, dims: int):
        self.node = rows["node"].to_numpy()
        self.copies = rows["copies"].to_numpy()
        self.exact = matrix(rows["vector"], dims)
        unit = _unit(self.exact)
        scale = np.abs(unit).max(axis=1) / 127
        whole = np.rint(unit / scale[:, None])
        self.whole = np.clip(whole, -127, 127).astype(np.int8).astype(np.float32)  # products stay exact
        near = self.whole * scale[:, None]
        self.scale = scale
        self.rest = np.sqrt(((unit - near) ** 2).sum(axis=1)) + ROUNDING
        self.size = np.sqrt((near**2).sum(axis=1)) + ROUNDING
        # before squaring, by the largest component, as in _unit
        self.exact = self.exact / np.abs(self.exact).max(axis=1, keepdims=True)
        self.norm = np.sqrt((self.exact**2).sum(axis=1))


def _linked(a: _Tile, b: _Tile, same: bool, cosine: float):
    """Positions (in a, in b) of all pairs with at least this cosine, strip by strip."""
    rest_b, size_b = b.rest.max(), b.size.max()
    for i in range(0, len(a.node), STRIP):
        rows = slice(i, i + STRIP)
        product = a.whole[rows] @ b.whole.T
        # the loosest vector of b first, to look at few pairs; then each pair's own bound
        most = a.size[rows] * rest_b + a.rest[rows] * size_b + a.rest[rows] * rest_b
        product *= b.scale.astype(np.float32)
        needed = ((cosine - most - ROUNDING) / a.scale[rows]).astype(np.float32)
        x, y = np.nonzero(product >= needed[:, None])
        x += i
        if same:
            x, y = x[x < y], y[x < y]
        for j in range(0, len(x), 500_000):
            p, q = x[j : j + 500_000], y[j : j + 500_000]
            whole = np.einsum("ij,ij->i", a.whole[p].astype(np.float64), b.whole[q].astype(np.float64))
            bound = a.scale[p] * b.scale[q] * whole
            bound += a.size[p] * b.rest[q] + a.rest[p] * b.size[q] + a.rest[p] * b.rest[q]
            p, q = p[bound >= cosine - ROUNDING], q[bound >= cosine - ROUNDING]
            exact = np.einsum("ij,ij->i", a.exact[p], b.exact[q]) / (a.norm[p] * b.norm[q])
            yield p[exact >= cosine], q[exact >= cosine]


def _pair_of_tiles(dims: int, cosine: float):
    kind = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        side = rows["side"].to_numpy()
        same = bool(len(side)) and side[0] == 2
        first = _Tile(rows.filter(pa.array(side != 1)), dims)
        second = first if same else _Tile(rows.filter(pa.array(side == 1)), dims)
        if not len(first.node) or not len(second.node):
            return kind.empty_table()
        count_a, count_b = np.zeros(len(first.node), np.int64), np.zeros(len(second.node), np.int64)
        held = LinkBuffer()
        for p, q in _linked(first, second, same, cosine):
            np.add.at(count_a, p, second.copies[q])
            np.add.at(count_b, q, first.copies[p])
            held.add(first.node[p], second.node[q])
        if same:
            count_a += count_b
        counted = [(first.node, count_a)] + ([] if same else [(second.node, count_b)])
        tables = [
            pa.table([pa.array(n[c > 0]), pa.array(c[c > 0]), pa.nulls(int((c > 0).sum()), pa.int64())], schema=kind)
            for n, c in counted
        ] + [pa.table([b.column("a"), pa.nulls(len(b), pa.int64()), b.column("b")], schema=kind) for b in held.batches()]
        return pa.concat_tables(tables)

    return run


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, tile: int = TILE, cells: int = CELLS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding)."""
    if not 0 < cosine <= 1:
        raise ValueError("the threshold is a cosine above 0")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector"))
    distinct = _distinct(rows)
    dims = width(distinct, "vector")
    centres = _centres(distinct, dims, cells)
    if len(centres):
        placed = cut_lineage(_in_cells(distinct, dims, centres))
        stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
        meetings, total = _meetings(stats, centres, cosine, tile), sum(r["n"] for r in stats)
        plain = -(-total // tile)
        if total * plain <= _copies(stats, meetings):
            placed, meetings = placed.withColumn("cell", F.lit(0)), [(0, plain, 0, plain)]
        dealt = _dealt(placed, meetings)
        found = dealt.groupBy("first", "second").applyInArrow(
            _pair_of_tiles(dims, cosine), "node long, links long, to long"
        )
        found = cut_lineage(found)
        links = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
        joined = components(found.where("`to` is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))
    else:
        links = distinct.select("node", F.lit(0).cast("long").alias("links")).limit(0)
        joined = distinct.select("node", F.col("node").alias("component")).limit(0)
    known = cut_lineage(
        distinct.join(links, "node", "left")
        .join(joined, "node", "left")
        .select(
            "vector", "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    least = cut_lineage(known.groupBy("component").agg(F.min("least").alias("component_id")))
    named = cut_lineage(known.join(least, "component").select("vector", "n_links", "component_id"))
    out = rows.join(named, "vector", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        # a vector that can't link is its own component; one that can may still have no id to name
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
