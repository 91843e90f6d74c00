"""Vector codes: one codebook a part, fitted in rounds with norm-of-sum bounds.

A vector's components become whole numbers floor(scale * x) and are cut into equal consecutive parts; a
part's code is the index of its nearest codebook entry. Codebooks start at given vectors and move, round
by round, to the floored means of the parts they are nearest to.

Every codebook of every round is kept. Next to its code a part carries a lower bound on its distance to
all other entries and the round in which that bound was measured, its stamp. In a later round no other
entry can be nearer than

    bound - max over the other entries of |entry now - entry at the stamp|

which takes the norm of the sum of an entry's moves, its true net displacement, where bounds that are
lowered every round add up the norms. Entries that go back and forth cost nothing. If the exact distance
to the part's own entry is below that, nothing else is looked at; otherwise all entries are measured
again and the bound gets a new stamp.

Codebooks are the only thing on the driver: parts x entries x components of a part, whatever the number
of vectors. A round maps the rows and writes them; the sums of a round come as one row for each entry
and task.

Defined results: vectors that are null or hold null or non-finite components are dropped; rows with a
null id stay and come last when the first entries are chosen, rows with equal ids are ordered by their
vector; repeated rows count each for itself; shorter vectors, and widths that the parts don't divide,
count as ending in zeros; fewer vectors than entries give smaller codebooks; an empty table gives none;
components and errors beyond 64 bits saturate; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.vectors import matrix, usable, width
from patronage.session import cut_lineage

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Rows that are worked on at once.
STRIP = 4096
#: Share of a bound that rounding may have cost.
ROUNDING = 1e-9
LARGEST = 2**63 - 1


def _squares(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole numbers, rows by entries."""
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most**2 * max(rows.shape[1], 1) < 2**53:
        rows, entries = rows.astype(np.float64), entries.astype(np.float64)
        found = (rows**2).sum(1)[:, None] + (entries**2).sum(1)[None, :] - 2 * rows @ entries.T
        return found.astype(np.int64)
    return ((rows.astype(object)[:, None, :] - entries.astype(object)[None, :, :]) ** 2).sum(axis=2)


def _own_squares(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to one entry of its own."""
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most**2 * max(rows.shape[1], 1) < 2**63:
        return ((rows - entries) ** 2).sum(axis=1)
    return ((rows.astype(object) - entries.astype(object)) ** 2).sum(axis=1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Bounds:
    """What one part's codebook of this round says about bounds of earlier rounds."""

    def __init__(self, history: list[np.ndarray]):
        self.entries, self.round = history[-1], len(history) - 1
        moved = np.stack([_roots(_own_squares(self.entries, old)) for old in history])  # stamps by entries
        self._far = moved.argmax(axis=1)
        self._most = moved.max(axis=1)
        moved[np.arange(len(history)), self._far] = 0
        self._next = moved.max(axis=1)

    def others(self, code: np.ndarray, bound: np.ndarray, stamp: np.ndarray) -> np.ndarray:
        """Least distance that any other entry can have now."""
        moved = np.where(self._far[stamp] == code, self._next[stamp], self._most[stamp])
        return bound * (1 - ROUNDING) - moved * (1 + ROUNDING)

    def assign(self, rows: np.ndarray, code: np.ndarray, bound: np.ndarray, stamp: np.ndarray):
        """(code, bound, stamp, squared distance, rows measured again) of this round."""
        code, bound, stamp = code.copy(), bound.copy(), stamp.copy()
        square = _own_squares(rows, self.entries[code])
        again = np.flatnonzero(~(_roots(square) * (1 + ROUNDING) < self.others(code, bound, stamp)))
        if len(again):
            found = _squares(rows[again], self.entries)
            code[again] = found.argmin(axis=1)  # the lower index of equals
            at = np.arange(len(again))
            square[again] = found[at, code[again]]
            rest = found.astype(np.float64)
            rest[at, code[again]] = np.inf
            bound[again], stamp[again] = np.sqrt(rest.min(axis=1)), self.round
        return code, bound, stamp, square, len(again)


STATE = "codes binary, bounds binary, stamps binary, error long, measured int"


def _assigned(rows: DataFrame, history: list[list[np.ndarray]], dims: int) -> DataFrame:
    """Codes, bounds and stamps after the newest codebooks; `history` holds, part by part, every round's."""
    parts, first = len(history), len(history[0]) == 1
    kept = ["vec_id", "label", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Bounds(h) for h in history]
        for whole in batches:
            for begin in range(0, whole.num_rows, STRIP):
                batch = whole.slice(begin, STRIP)
                n = batch.num_rows
                v = matrix(batch.column("v"), dims, np.int64).reshape(n, parts, -1)
                if first:  # no bound yet
                    codes, stamps = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.uint8)
                    bounds = np.full((n, parts), -np.inf)
                else:
                    codes, stamps, bounds = (
                        np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(n, parts).copy()
                        for c, t in (("codes", np.uint8), ("stamps", np.uint8), ("bounds", np.float64))
                    )
                error, measured = 0, 0
                for p, bound in enumerate(known):
                    codes[:, p], bounds[:, p], stamps[:, p], square, again = bound.assign(
                        v[:, p], codes[:, p], bounds[:, p], stamps[:, p]
                    )
                    error, measured = error + square, measured + again
                blobs = [pa.array([row.tobytes() for row in x], pa.binary()) for x in (codes, bounds, stamps)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *blobs]
                    + [pa.array(np.minimum(error, LARGEST).astype(np.int64)), pa.array([measured] + [0] * (n - 1), pa.int32())],
                    [*kept, "codes", "bounds", "stamps", "error", "measured"],
                )

    return rows.mapInArrow(run, f"vec_id long, label {dict(rows.dtypes)['label']}, v array<long>, {STATE}")


def _means(state: DataFrame, codebooks: list[np.ndarray], dims: int) -> list[np.ndarray]:
    """The entries moved to the floored means of their parts; unused ones stay."""
    parts = len(codebooks)
    entries, size = codebooks[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v"), dims, np.int64).reshape(batch.num_rows, parts, size)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                np.add.at(counts[p], codes[:, p], 1)
                np.add.at(sums[p], codes[:, p], v[:, p])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry])]
            + [pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))],
            ["part", "entry", "n", "sums"],
        )

    found = state.select("v", "codes").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    added = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(size)]
    out = [c.copy() for c in codebooks]
    for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():  # parts x entries at most
        out[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(size)]
    return out


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    vector: str = "embedding",
) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, v, codes, error, ...) of every vector, the final codebook of every part)."""
    if not 0 < entries <= 256 or not 0 <= rounds < 256:
        raise ValueError("codes and stamps are bytes")
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    given = vectors.where(usable(F.col(vector))).select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("v"))
    size = max(1, -(-width(given, "v") // parts))
    dims = size * parts
    # the first vectors by id, one for each entry
    start = given.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").toArrow()
    if not start.num_rows:
        empty = "vec_id long, label " + dict(given.dtypes)["label"] + ", v array<long>, " + STATE
        return vectors.sparkSession.createDataFrame([], empty), []
    history = [[c] for c in matrix(start["v"], dims, np.int64).reshape(-1, parts, size).swapaxes(0, 1)]
    state = given
    for _ in range(rounds):
        state = cut_lineage(_assigned(state, history, dims))
        for books, moved in zip(history, _means(state, [h[-1] for h in history], dims)):
            books.append(moved)
    return cut_lineage(_assigned(state, history, dims)), [h[-1] for h in history]


def digests(coded: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of coded vectors."""
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(LARGEST).cast("decimal(20,0)")).cast("long")
    of_label = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "_label")
    joined = coded.join(of_label, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(digest(codebooks)).alias("codebooks_sha256"),
    )
