"""Bound-certified best-fit packing of documents into sequences of at most `capacity` tokens.

Documents become pieces: only a document longer than the capacity is cut, into full pieces and a last
one. Full pieces are sequences by themselves. All others are dealt out to groups of about
`group_items` pieces; each group is packed best-fit decreasing, and lower bounds by dual feasible
functions certify its number of sequences. A group with a gap between that number and the bound gives
back the documents of all sequences that aren't full; a certified group gives back its emptiest one.
What comes back is exchanged: dealt anew to fewer groups and packed again, until the bound over all
pieces is met, one group held all that was left, or a round saved nothing.

Defined results: a null or empty text is a document of one token, the end id; null doc_ids and
repeated rows are packed like all others; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.tokens import token_slices
from patronage.session import cut_lineage

CAPACITY = 2048
GROUP_ITEMS = 16_384
ROUNDS = 6
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document's ids (text's ids, then `end_id`), with the crc32 of each."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(name, pa.int64()) for name in ("start", "length", "ids_crc32")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, flat, sizes in token_slices(batches, vocabulary, end_id):
            count = -(-sizes // capacity)
            piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(np.repeat(sizes, count) - start, capacity)
            ids = flat.astype("<u4").tobytes()
            ends = np.cumsum(length) * 4
            crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - length * 4).tolist(), ends.tolist())]
            of = doc_ids.take(pa.array(np.repeat(np.arange(len(sizes)), count)))
            yield pa.RecordBatch.from_arrays(
                [of, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                schema=schema,
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that pieces need at least; `counts` by length, 0 to capacity.

    The largest of three families of dual feasible functions: the identity, the one that forgets
    pieces below a threshold and fills sequences with those above its complement, and rounding to
    multiples of capacity / k. Everything is in whole numbers.
    """
    length = np.flatnonzero(counts)
    if not len(length):
        return 0
    number = counts[length].astype(np.int64)
    best = -(-int((length * number).sum()) // capacity)
    for limit in np.unique(np.minimum(length, capacity - length)).tolist():
        if 0 < limit <= capacity // 2:
            value = np.where(length > capacity - limit, capacity, np.where(length >= limit, length, 0))
            best = max(best, -(-int((value * number).sum()) // capacity))
    for k in range(1, 65):
        scaled = length * (k + 1)
        # f(x) = x where (k + 1) x / C is whole, else floor((k + 1) x / C) C / k; here times k / C
        value = np.where(scaled % capacity == 0, length * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * number).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sequence and offset of each piece, and the room left in each sequence.

    Open sequences stand in one stack for each amount of room; a bit mask of the amounts in use
    gives the tightest fit at once.
    """
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    room: list[int] = []
    mask = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            at = stacks[left].pop()
            if not stacks[left]:
                mask &= ~(1 << left)
        else:
            left, at = capacity, len(room)
            room.append(capacity)
        sequence[i], offset[i] = at, capacity - left
        room[at] = left = left - size
        if left:
            stacks[left].append(at)
            mask |= 1 << left
    return sequence, offset, room


def _pack_group(capacity: int, turn: int):
    def pack(rows: pa.Table) -> pa.Table:
        group = rows["part"][0].as_py()
        rows = rows.drop_columns("part").sort_by([(c, "ascending") for c in rows.column_names if c != "part"])
        lengths = rows["length"].to_numpy()
        sequence, offset, room = best_fit_decreasing(lengths, capacity)
        left = np.array(room, np.int64)
        gap = len(room) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        # without a gap only the emptiest sequence can be of use to other groups
        released = (left > 0) & ((gap > 0) | (left == left.max()))
        # 6 bits for the round, 33 for the group, 24 for the sequence
        rows = rows.append_column("sequence_id", pa.array((turn << 57) + (group << 24) + sequence))
        return rows.append_column("offset", pa.array(offset)).append_column("released", pa.array(released[sequence]))

    return pack


def _round(items: DataFrame, groups: int, capacity: int, turn: int) -> DataFrame:
    """Deal the pieces to groups by a hash of all their columns and pack each group."""
    # rows that are equal in everything would land in one group: the running number parts them
    keys = [*items.columns, F.monotonically_increasing_id(), F.lit(turn)]
    dealt = items.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(groups)))
    schema = f"{PACKED}, released boolean"
    return dealt.groupBy("part").applyInArrow(_pack_group(capacity, turn), schema)


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Pieces with their sequence and place."""
    columns = [c.split()[0] for c in PIECES.split(", ")]
    kept = [c.split()[0] for c in PACKED.split(", ")]
    items = cut_lineage(items.select(*columns))
    full = items.where(F.col("length") == capacity)
    own = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    done = [own.withColumn("offset", F.lit(0).cast("long"))]
    rest = items.where(F.col("length") < capacity)
    bound, left = bounds(rest, capacity)
    frozen, loose, loose_used = 0, None, 0
    for turn in range(1, ROUNDS + 1):
        if not left:
            break
        groups = max(1, -(-left // group_items))
        packed = cut_lineage(_round(rest.select(*columns), groups, capacity, turn))
        opens = F.col("offset") == 0
        used, left, given = packed.agg(
            F.count_if(opens), F.count_if("released"), F.count_if(F.col("released") & opens)
        ).first()
        if loose is not None and used >= loose_used:
            break  # the exchange saved nothing: these pieces stay where the round before put them
        done.append(packed.where(~F.col("released")).select(*kept))
        rest = packed.where("released")
        loose, loose_used, frozen = rest.select(*kept), given, frozen + used - given
        if frozen + given <= bound or groups == 1:
            break
    if loose is not None:
        done.append(loose)
    return reduce(DataFrame.unionByName, done)


def _histogram(items: DataFrame, capacity: int) -> tuple[np.ndarray, int]:
    """Pieces by length, at most `capacity` rows, and their number."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    return counts, int(counts.sum())


def bounds(items: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Lower bound on the sequences of all pieces, and the pieces' number."""
    counts, number = _histogram(items, capacity)
    return lower_bound(counts, capacity), number


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Every document of `docs`, tokenised and packed."""
    return pack(pieces(docs, vocabulary, end_id, capacity), capacity)
