"""Token ids in files: canonical length-limited Huffman codes in independent blocks.

A store is a folder of three tables that Spark writes and commits, so that a lost executor leaves no
half file behind:

* `codes` (id, bits): the length of each id's code, from the counts over all documents. Codes are
  canonical: in the order of (bits, id), each one the next number of its length.
* `blocks` (shard, block, docs, counts, sizes, marks, payload): whole documents in ascending order. `payload`
  is the bits of all their ids, most significant first, each document beginning on a whole byte.
  `marks` is the bit offset of every `MARK`-th id of each document, so that a reader can start there.
* `shards` (shard, ids_before): ids in all shards before.

Texts are tokenised once: their ids are written as whole numbers of 2 or 4 bytes, counted there, dealt
to the shards by ranges of doc_id, and coded by the task that holds their shard in order.

Any block is read on its own. Decoding starts at all marks of a block at once and looks the next code
up in a table by the next `max_bits` bits.

Documents stand in ascending doc_id order, null first; rows that repeat a doc_id stand together in the
order of their lengths and ids, over more than one shard if they are many, and each one is returned. A null or empty text has the end id only.
An empty table gives an empty store. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.tokens import token_slices
from patronage.llm.worker import keep
from patronage.session import cut_lineage

MAX_BITS = 18
MARK = 128
#: Bytes of payload after which a block ends with the document it is in.
BLOCK_BYTES = 262_144
#: Ids that are coded at once.
ENCODED = 1_000_000
#: Ids of a shard, which one task writes; their number grows with the input.
SHARD_IDS = 4_000_000
#: Shards whose ids are added up together.
GROUPED = 4096
IDS = "doc_id long, n_tokens long, width int, ids binary"
BLOCKS = (
    "shard int, block int, docs array<long>, counts array<long>, sizes array<long>, marks array<long>, payload binary"
)


def tokenised(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """IDS rows: the ids of every document, `end_id` last, as numbers of `width` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, flat, sizes in token_slices(batches, vocabulary, end_id):
            width = 2 if flat.max(initial=0) < 1 << 16 else 4
            ends = pa.py_buffer((width * np.concatenate([[0], np.cumsum(sizes)])).astype(np.int32))
            data = pa.py_buffer(flat.astype(f"<u{width}"))
            ids = pa.Array.from_buffers(pa.binary(), len(sizes), [None, ends, data])
            columns = [doc_ids, pa.array(sizes), pa.array(np.full(len(sizes), width, np.int32)), ids]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "width", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, IDS)


def _stored(batches: Iterator[pa.RecordBatch], most: int = ENCODED):
    """(doc_ids, flat ids, counts) of IDS rows, in parts of about `most` ids."""
    for batch in batches:
        sizes, widths = batch.column("n_tokens").to_numpy(), batch.column("width").to_numpy()
        ends, begin = np.cumsum(sizes), 0
        while begin < len(sizes):
            held = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, held + most)))
            raw = batch.column("ids").slice(begin, end - begin).to_pylist()
            if (widths[begin:end] == 2).all():
                flat = np.frombuffer(b"".join(raw), "<u2").astype(np.int32)
            else:
                parts = [np.frombuffer(x, f"<u{w}") for x, w in zip(raw, widths[begin:end].tolist())]
                flat = np.concatenate(parts).astype(np.int32)
            yield batch.column("doc_id").slice(begin, end - begin), flat, sizes[begin:end]
            begin = end


def count_ids(coded: DataFrame) -> DataFrame:
    """(id, count) over all IDS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for _, flat, _ in _stored(batches):
            part = np.bincount(flat, minlength=len(total))
            part[: len(total)] += total
            total = part
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "count"])

    counted = coded.select("doc_id", "n_tokens", "width", "ids").mapInArrow(run, "id long, count long")
    return counted.groupBy("id").agg(F.sum("count").alias("count"))


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with at most `max_bits` bits, by package-merge.

    Each of the `max_bits` rounds pairs the cheapest packages so far and adds the single ids again; an
    id's length is the number of times it is in the 2n - 2 cheapest of the last round.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    weight = counts[order].astype(np.float64)
    levels, packed = [], np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([weight, packed])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)  # which of the sorted packages are single ids
        merged = merged[rank]
        packed = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for single in reversed(levels):
        ids = int(single[:taken].sum())  # the cheapest ids, since both kinds keep their order
        lengths[order[:ids]] += 1
        taken = 2 * (taken - ids)
    return lengths


def canonical(ids: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, bits) by id; bits is 0 where an id has no code."""
    order = np.lexsort((ids, bits))
    by_id = np.zeros((2, int(ids.max(initial=-1)) + 1), np.int64)
    code, length = 0, 0
    for i, b in zip(ids[order].tolist(), bits[order].tolist()):
        code <<= b - length
        length = b
        by_id[:, i] = code, b
        code += 1
    return by_id[0], by_id[1]


def lookup(ids: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, bits) by the next `width` bits of a payload, and that width."""
    width = int(bits.max(initial=1))
    order = np.lexsort((ids, bits))
    span = 1 << (width - bits[order])
    table = np.repeat(ids[order], span).astype(np.int32)
    length = np.repeat(bits[order], span).astype(np.uint8)
    rest = (1 << width) - len(table)
    return np.pad(table, (0, rest)), np.pad(length, (0, rest), constant_values=1), width


def encode_ids(flat: np.ndarray, sizes: np.ndarray, code: np.ndarray, bits: np.ndarray):
    """(payload, begin and size of each document's bytes, bit offset of each id in its document)."""
    length = bits[flat]
    ends = np.cumsum(length)
    of = np.concatenate([[0], np.cumsum(sizes)])
    doc_bits = np.diff(np.concatenate([[0], ends])[of])
    doc_bytes = (doc_bits + 7) // 8
    doc_begin = np.cumsum(doc_bytes) - doc_bytes
    inside = ends - length - np.repeat(np.concatenate([[0], ends])[of[:-1]], sizes)
    at = inside + np.repeat(doc_begin * 8, sizes)
    # a code of up to 32 bits covers at most two of the 32-bit words; codes never overlap, so sums do
    shifted = code[flat] << (64 - length - (at & 31))
    words = at >> 5
    n = int(doc_bytes.sum() // 4 + 2)
    high = np.bincount(words, weights=(shifted >> 32) & 0xFFFFFFFF, minlength=n)
    low = np.bincount(words + 1, weights=shifted & 0xFFFFFFFF, minlength=n)
    payload = (high[:n] + low[:n]).astype(np.uint64).astype(">u4").tobytes()
    return payload, doc_begin, doc_bytes, inside


def decode_payload(payload: bytes, starts: np.ndarray, sizes: np.ndarray, table, length, width: int) -> np.ndarray:
    """Ids that begin at each of the bit offsets `starts`, `sizes` of them each, in order."""
    raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint64)
    # the 32 bits from each byte on
    window = (raw[:-4] << 24 | raw[1:-3] << 16 | raw[2:-2] << 8 | raw[3:-1]).astype(np.int64)
    out = np.empty(int(sizes.sum()), np.int32)
    place = np.cumsum(sizes) - sizes
    at, mask = starts.copy(), (1 << width) - 1
    live = np.arange(len(starts))
    for step in range(int(sizes.max(initial=0))):
        live = live[sizes[live] > step]
        bit = at[live]
        found = (window[bit >> 3] >> (32 - width - (bit & 7))) & mask
        out[place[live] + step] = table[found]
        at[live] = bit + length[found]
    return out


def _marks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of every MARK-th id among all ids, and the number of marks of each document."""
    number = -(-sizes // MARK)
    inside = (np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)) * MARK
    return inside + np.repeat(np.cumsum(sizes) - sizes, number), number


def _to_blocks(shared, block_bytes: int):
    """Documents of a shard, in order, coded and joined to blocks. `shared` holds codes and their bits by id."""
    kind = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32())]
        + [(n, pa.list_(pa.int64())) for n in ("docs", "counts", "sizes", "marks")]
        + [("payload", pa.binary())]
    )

    def block(shard: int, number: int, parts: list) -> pa.RecordBatch:
        docs = pa.concat_arrays([p[0] for p in parts])
        counts, sizes, number_of_marks, inside = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
        marks = inside + np.repeat((np.cumsum(sizes) - sizes) * 8, number_of_marks)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (docs, *map(pa.array, (counts, sizes, marks)))]
        payload = b"".join(p[5] for p in parts)
        ids = [pa.array([shard], pa.int32()), pa.array([number], pa.int32())]
        return pa.RecordBatch.from_arrays([*ids, *lists, pa.array([payload], pa.binary())], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, bits = shared.value
        shard, number, held, parts = TaskContext.get().partitionId(), 0, 0, []
        for doc_ids, flat, counts in _stored(batches):
            payload, begin, size, inside = encode_ids(flat, counts, code, bits)
            at, marks = _marks(counts)
            ends, mark_ends, first = np.cumsum(size), np.concatenate([[0], np.cumsum(marks)]), 0
            while first < len(size):
                # up to the document with which the block is full
                full = int(begin[first]) + block_bytes - held
                last = min(first + int(np.searchsorted(ends[first:], full)), len(size) - 1) + 1
                some = slice(first, last)
                own = inside[at[mark_ends[first] : mark_ends[last]]]
                data = payload[int(begin[first]) : int(ends[last - 1])]
                parts.append((doc_ids.slice(first, last - first), counts[some], size[some], marks[some], own, data))
                held += len(data)
                if held >= block_bytes:
                    yield block(shard, number, parts)
                    number, held, parts = number + 1, 0, []
                first = last
        if parts:
            yield block(shard, number, parts)

    return run


def write(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, shard_ids: int = SHARD_IDS, max_bits: int = MAX_BITS
) -> None:
    """Write the ids of all documents, `end_id` after each, as a store below `path`."""
    spark = docs.sparkSession
    coded = cut_lineage(tokenised(docs, vocabulary, end_id))
    counted = count_ids(coded).orderBy("id").toArrow()  # a row for each id at most
    ids, counts = counted["id"].to_numpy(), counted["count"].to_numpy()
    lengths = code_lengths(counts, max_bits)
    code, bits = canonical(ids, lengths)
    codes = pa.table({"id": ids, "bits": lengths})
    spark.createDataFrame(codes).coalesce(1).write.parquet(f"{path}/codes")
    shared = spark.sparkContext.broadcast((code, bits))  # bounded by the vocabulary
    shards = max(1, -(-int(counts.sum()) // shard_ids))
    # the hash spreads a doc_id that very many rows have over shards
    keys = ["doc_id", "n_tokens", "_hash"]
    dealt = coded.withColumn("_hash", F.xxhash64("ids")).repartitionByRange(shards, *keys).sortWithinPartitions(*keys, "ids")
    blocks = dealt.drop("_hash").mapInArrow(_to_blocks(shared, BLOCK_BYTES), BLOCKS)
    # the bits are as dense as they get
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    held = spark.read.parquet(f"{path}/blocks").select("shard", F.explode("counts").alias("n"))
    totals = held.groupBy("shard").agg(F.sum("n").alias("n")).withColumn("group", F.floor(F.col("shard") / GROUPED))
    groups = totals.groupBy("group").agg(F.sum("n").alias("n"))  # few rows, which a window over all may hold
    before = F.coalesce(F.sum("n").over(_earlier("group")), F.lit(0))
    groups = groups.select(F.col("group").alias("_group"), before.alias("_before"))
    inside = F.coalesce(F.sum("n").over(_earlier("shard", "group")), F.lit(0))
    begun = totals.withColumn("_inside", inside).join(groups, F.col("group") == F.col("_group"))
    begun.select("shard", (F.col("_before") + F.col("_inside")).alias("ids_before")).write.parquet(f"{path}/shards")


def _cached_lookup(ids: bytes, bits: bytes):
    return keep(("codes", ids, bits), lambda: lookup(np.frombuffer(ids, np.int64), np.frombuffer(bits, np.int64)))


def _decoded(spark: SparkSession, path: str, make, schema: str) -> DataFrame:
    """`make(batch row by row)` over the blocks: gets doc_ids, counts, flat ids and the row."""
    codes = spark.read.parquet(f"{path}/codes").toArrow()
    shared = spark.sparkContext.broadcast(tuple(codes[c].to_numpy().astype(np.int64).tobytes() for c in ("id", "bits")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, length, width = _cached_lookup(*shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                lists = {n: row.column(n).flatten() for n in ("docs", "counts", "marks")}
                counts = lists["counts"].to_numpy()
                number = -(-counts // MARK)
                last = np.cumsum(number) - 1
                sizes = np.full(int(number.sum()), MARK, np.int64)
                sizes[last] = counts - (number - 1) * MARK
                flat = decode_payload(
                    row.column("payload")[0].as_py(), lists["marks"].to_numpy(), sizes, table, length, width
                )
                yield make(row, lists["docs"], counts, flat)

    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, schema)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of every document of a store."""

    def make(row, docs, counts, flat) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), flat)
        return pa.RecordBatch.from_arrays([docs, lists], ["doc_id", "ids"])

    return _decoded(spark, path, make, "doc_id long, ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a store, from its decoded ids."""

    def make(row, docs, counts, flat) -> pa.RecordBatch:
        raw, ends = flat.astype("<u4").tobytes(), np.cumsum(counts) * 4
        begins = ends - counts * 4
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
        n = len(counts)
        same = [row.column(c).take(pa.array(np.zeros(n, np.int64))) for c in ("shard", "block")]
        return pa.RecordBatch.from_arrays(
            [*same, docs, pa.array(begins // 4), pa.array(counts), pa.array(crc, pa.int64())],
            ["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
        )

    found = _decoded(
        spark, path, make, "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    # where each block begins: a row for each block, added up within its shard
    blocks = spark.read.parquet(f"{path}/blocks").select("shard", "block", "counts")
    sizes = blocks.select("shard", "block", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    sizes = sizes.join(spark.read.parquet(f"{path}/shards"), "shard")
    earlier = F.sum("n").over(_earlier("block", "shard"))
    begins = sizes.select("shard", "block", (F.col("ids_before") + F.coalesce(earlier, F.lit(0))).alias("begin"))
    joined = found.join(begins, ["shard", "block"])
    return joined.select("doc_id", (F.col("begin") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def _earlier(order: str, *within: str):
    return Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
