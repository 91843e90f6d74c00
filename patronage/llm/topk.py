"""Exact top-k by inner product with a cover tree over queries and data together.

The tree's nodes are centres out of a sample of at most `SAMPLE` vectors of both kinds; every level
has a smaller covering radius by the factor `SHRINK`, and the levels end with as many leaves as the rows
fill to about `LEAF_ROWS`, `LEAVES` at least. Every row, query or datum, goes to its nearest leaf, and
radii and largest norms of both kinds are measured over all rows, so both bounds are rigorous whatever
the sample was:

    <q, p> <= <cq, cp> + rq |cp| + rp |cq| + rq rp
    <q, p> <= (nq^2 + np^2 - max(0, |cq - cp| - rq - rp)^2) / 2

The second is the cone's: of vectors no longer than n, only near ones have a large product.

First each query group (leaf) meets the data leaves nearest to it, until they hold enough rows; that
gives every group its worst kth score. Then node pairs are walked from the root: a pair whose bound
is below the query group's worst kth score is dropped with all below it, and the leaf pairs that are
left are scored. The walk is over the tree only, whose size is a parameter; the scoring is a
Spark job in blocks of data rows, and every data row stands in one block only.

Vectors are compared as whole numbers floor(scale * x). A vector that occurs often is scored once and
keeps the k + 1 smallest ids that have it: more can't be among k results when ties go to small ids.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows
without an id; shorter vectors count as ending in zeros; rows equal in id and vector count once; a
query never finds rows with its own id; fewer candidates give fewer rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.vectors import distances, matrix, usable, width
from patronage.session import cut_lineage

SCALE = 1024
SAMPLE = 2048
LEAVES = 64
LEAF_ROWS = 512
SHRINK = 0.85
BLOCK = 2048
QUERY_BLOCK = 4096
#: Data rows that a query group meets at first, as a multiple of k.
FIRST = 20
SCORED = "query_id long, vec_id long, score long"


class CoverTree:
    """Centres, level by level: `parent` of each node, `leaf` nodes, and their vectors."""

    def __init__(self, rows: np.ndarray, most_leaves: int):
        level = [0]
        self.rows, self.children, self.depth = [rows[0]], [[]], 0
        of = np.zeros(len(rows), np.int64)  # node that covers each row
        far = distances(rows, rows[:1])[:, 0]
        radius = far.max() * SHRINK
        while radius > 0 and len(level) < most_leaves and far.max() > 0:
            new = []
            for node in level:
                inside = np.flatnonzero(of == node)
                # greedy net: the node's own centre goes on, then rows that no centre covers yet
                centre = self._add(node, self.rows[node])
                of[inside], far[inside] = centre, distances(rows[inside], self.rows[node][None])[:, 0]
                new.append(centre)
                # a level that would have very many leaves covers the rest from where they are
                while len(inside) and far[inside].max() > radius and len(new) < 4 * most_leaves:
                    row = inside[far[inside].argmax()]
                    centre = self._add(node, rows[row])
                    reach = distances(rows[inside], rows[row][None])[:, 0]
                    closer = reach < far[inside]
                    of[inside[closer]], far[inside[closer]] = centre, reach[closer]
                    new.append(centre)
            level, radius, self.depth = new, radius * SHRINK, self.depth + 1
        self.leaf = np.array(level)
        self.centres = np.array(self.rows)

    def _add(self, parent: int, row: np.ndarray) -> int:
        self.rows.append(row)
        self.children.append([])
        self.children[parent].append(len(self.rows) - 1)
        return len(self.rows) - 1

    def radii(self, of_leaf: np.ndarray) -> np.ndarray:
        """Covering radius of every node, from that of the leaves; -1 where there is nothing below."""
        out = np.full(len(self.rows), -1.0)
        out[self.leaf] = of_leaf
        for node in range(len(self.rows) - 1, -1, -1):
            for child in self.children[node]:
                if out[child] >= 0:
                    out[node] = max(out[node], out[child] + np.linalg.norm(self.centres[node] - self.centres[child]))
        return out

    def highest(self, of_leaf: np.ndarray) -> np.ndarray:
        """Largest value of the leaves below every node."""
        return -self.lowest(-of_leaf)

    def lowest(self, of_leaf: np.ndarray) -> np.ndarray:
        """Smallest value of the leaves below every node."""
        out = np.full(len(self.rows), np.inf)
        out[self.leaf] = of_leaf
        for node in range(len(self.rows) - 1, -1, -1):
            for child in self.children[node]:
                out[node] = min(out[node], out[child])
        return out

    def pairs(self, queries: Reach, data: Reach, worst: np.ndarray) -> list[tuple[int, int]]:
        """Leaf pairs (positions in `leaf`) that may hold a score as good as the group's worst kth."""
        rq, rp, worst = self.radii(queries.radius), self.radii(data.radius), self.lowest(worst)
        nq, np_ = self.highest(queries.norm), self.highest(data.norm)
        norm, place = np.linalg.norm(self.centres, axis=1), {n: i for i, n in enumerate(self.leaf.tolist())}
        found, open_pairs = [], [(0, 0)]
        while open_pairs:
            q, p = open_pairs.pop()
            if rq[q] < 0 or rp[p] < 0:
                continue
            bound = self.centres[q] @ self.centres[p] + rq[q] * norm[p] + rp[p] * norm[q] + rq[q] * rp[p]
            apart = max(np.linalg.norm(self.centres[q] - self.centres[p]) - rq[q] - rp[p], 0.0)
            bound = min(bound, (nq[q] ** 2 + np_[p] ** 2 - apart**2) / 2)
            if bound + 1e-9 * abs(bound) + 1e-6 < worst[q]:
                continue
            if q in place and p in place:
                found.append((place[q], place[p]))
            elif p in place or q not in place and rq[q] >= rp[p]:
                open_pairs += [(c, p) for c in self.children[q]]
            else:
                open_pairs += [(q, c) for c in self.children[p]]
        return found


class Reach:
    """Covering radius and largest norm of the rows of every leaf; -1 and 0 where there are none."""

    def __init__(self, leaves: int):
        self.radius, self.norm, self.n = np.full(leaves, -1.0), np.zeros(leaves), np.zeros(leaves, np.int64)

    @classmethod
    def of(cls, placed: DataFrame, leaves: int) -> Reach:
        out = cls(leaves)
        stats = placed.groupBy("leaf").agg(F.count("*").alias("n"), F.max("far").alias("far"), F.max("norm").alias("norm"))
        for r in stats.collect():  # a row a leaf
            out.n[r["leaf"]], out.radius[r["leaf"]], out.norm[r["leaf"]] = r["n"], r["far"], r["norm"]
        return out


def _whole(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """(vec_id, v) with v in whole numbers, each (id, vector) once."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col(vector)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return rows.select(F.col("vec_id").cast("long"), whole.alias("v")).distinct()


def _assigned(rows: DataFrame, dims: int, centres: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            v = matrix(batch.column("v"), dims)
            far = distances(v, centres)
            leaf = far.argmin(axis=1)
            names, norm = batch.schema.names, np.linalg.norm(v, axis=1)
            columns = [pa.array(leaf, pa.int32()), pa.array(far[np.arange(len(leaf)), leaf]), pa.array(norm)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, "leaf", "far", "norm"])

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, leaf int, far double, norm double")


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _score_block(dims: int, k: int, strip: int = 256):
    """The best k of a block of data for each of its queries."""

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and data.num_rows:
            rows = matrix(data["v"], dims, np.int64)
            size = np.diff(data["ids"].combine_chunks().offsets.to_numpy())
            ids = data["ids"].combine_chunks().flatten().to_numpy()
            first = np.cumsum(size) - size
            query_ids, wanted = queries["query_id"].to_numpy(), matrix(queries["v"], dims, np.int64)
            for i in range(0, len(wanted), strip):
                scores = _products(wanted[i : i + strip], rows)
                n = min(k + 1, scores.shape[1])  # one more, as the query itself may be among them
                least = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
                q, p = np.nonzero(scores >= least[:, None])
                score = np.repeat(scores[q, p], size[p])
                query = np.repeat(query_ids[i + q], size[p])
                at = np.arange(len(score)) - np.repeat(np.cumsum(size[p]) - size[p], size[p])
                vec = ids[np.repeat(first[p], size[p]) + at]
                order = np.lexsort((vec, -score, query))
                query, vec, score = (x[order][vec[order] != query[order]] for x in (query, vec, score))
                begin = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])[: len(query)])
                rank = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
                out.append(pa.table({"query_id": query[rank < k], "vec_id": vec[rank < k], "score": score[rank < k]}))
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        return pa.concat_tables([empty, *out])

    return run


def _scored(queries: DataFrame, data: DataFrame, pairs: list, dims: int, k: int) -> DataFrame:
    """Partial results of the leaf pairs. Queries go to the blocks; a data row is in one block for each
    `QUERY_BLOCK` of all queries."""
    spark = data.sparkSession
    met = spark.createDataFrame(pairs, "query_leaf int, leaf int, blocks int")
    asked = queries.join(met, queries["leaf"] == F.col("query_leaf")).select(
        met["leaf"], F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "part", "query_id", "v"
    )
    keys = ["leaf", "block", "part"]
    return asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(_score_block(dims, k), SCORED)


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame, is_query, k: int = 10, vector: str = "embedding", scale: int = SCALE, leaves: int = LEAVES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row that `is_query` holds for."""
    spark = vectors.sparkSession
    rows = cut_lineage(_whole(vectors, vector, scale))
    dims = width(rows, "v")
    sample = rows.orderBy(F.xxhash64("v"), "vec_id").limit(SAMPLE).select("v").toArrow()
    if not sample.num_rows or not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # leaves that shrink as the data grow, as far as the sample goes
    tree = CoverTree(matrix(sample["v"], dims), min(max(leaves, -(-rows.count() // LEAF_ROWS)), SAMPLE // 4))
    centres = tree.centres[tree.leaf]

    few = Window.partitionBy("v").orderBy("vec_id")
    ids = rows.withColumn("n", F.row_number().over(few)).where(F.col("n") <= k + 1)
    ids = ids.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 at most
    data = cut_lineage(_assigned(ids, dims, centres))
    asked = rows.where(is_query).withColumnRenamed("vec_id", "query_id")
    asked = cut_lineage(_assigned(asked, dims, centres))

    reach, groups = Reach.of(data, len(centres)), Reach.of(asked, len(centres))
    held, total = reach.n, int(groups.n.sum())
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    blocks = np.maximum(-(-held // BLOCK), 1)
    parts = -(-total // QUERY_BLOCK)
    of_leaf = spark.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "leaf int, blocks int")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    data = data.join(of_leaf, "leaf").select(
        "leaf", F.pmod(F.xxhash64("v"), "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "v", "ids",
    )

    def with_blocks(pairs) -> list[tuple[int, int, int]]:
        return [(int(q), int(p), int(blocks[p])) for q, p in pairs]

    near, seeds = distances(centres, centres), []
    for q in np.flatnonzero(groups.n):
        order = [p for p in np.argsort(near[q], kind="stable") if held[p]]
        enough = int(np.searchsorted(np.cumsum(held[order]), FIRST * k)) + 1
        seeds += [(q, p) for p in order[:enough]]
    first = cut_lineage(_scored(asked, data, with_blocks(seeds), dims, k))

    # a group's worst kth score; a query that has fewer than k so far can't exclude anything
    kth = _best(first, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    kth = asked.select("query_id", "leaf").join(kth, "query_id", "left")
    kth = kth.withColumn("score", F.when(F.col("n") >= k, F.col("score")))
    worst = np.full(len(centres), np.inf)
    for r in kth.groupBy("leaf").agg(F.min("score").alias("score"), F.count_if(F.col("score").isNull()).alias("open")).collect():
        worst[r["leaf"]] = -np.inf if r["open"] else r["score"]
    done = set(seeds)
    rest = [pair for pair in tree.pairs(groups, reach, worst) if pair not in done]
    scored = first.unionByName(_scored(asked, data, with_blocks(rest), dims, k)) if rest else first
    return _best(scored, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
