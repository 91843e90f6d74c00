"""Line dedup: lines that many documents share go from all of them but one.

Distinct line hashes (128 bits of the stripped, lower-cased line) that at least `min_docs` documents
hold are dealt to shards. Each shard gets a minimal perfect hash: levels of bits in which a key's place
is set if no other key of the level has it; keys that clash go on to the next level, and a set bit's
rank is the key's slot. The slots index plain arrays: a fingerprint (the half of the hash that rules
out every other line), the number of documents, and the document that keeps the line. A shard is one
row of a written table; lines themselves are never stored or joined.

Documents send the hashes of their long lines to the shards' tasks, which probe the arrays and answer
with the hashes that the document loses. Shards are as many as bound both the keys of a shard and the
hashes sent to it; the hashes of lines that very many documents hold are salted over several tasks, each
with a copy of the shard. Answers are put together per row and the text is rebuilt where it lies.

Defined results: a null or empty text is one empty line; only `[\\x20\\x09-\\x0D]` is stripped and only A-Z
is lowered; rows with one doc_id are one document when documents are counted, and each loses its lines;
rows without a doc_id aren't counted and never keep a line; a line repeated inside the document that
keeps it stays repeated; an empty table gives an empty table; other columns stay, but for columns of the
input named like the two new ones, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.frames import aside, restored
from patronage.llm.tokens import slices
from patronage.session import cut_lineage

MIN_LENGTH = 40
MIN_DOCS = 5
BLANK = " \t\n\x0b\x0c\r"
#: Keys of a shard, and hashes that its task probes at once.
SHARD_KEYS = 50_000
SHARD_PROBES = 500_000
#: Bytes of text that are cut into lines at once.
SLICE = 4_000_000
#: Bits of a level for each key that it has to place.
SPARE = 2
ROW = ["doc_id", "_a", "_b"]


def cut(texts: pa.Array, min_length: int) -> tuple[pa.Array, np.ndarray, np.ndarray, list[bytes]]:
    """(lines, lines of each text, places of long lines among them, 16-byte hashes of their keys)."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    keys = pc.utf8_trim(lines, characters=BLANK)
    long = np.flatnonzero(pc.utf8_length(keys).to_numpy(zero_copy_only=False) >= min_length)
    lowered = pc.ascii_lower(keys.take(pa.array(long))).cast(pa.binary())
    return lines, sizes, long, [xxhash.xxh3_128_digest(k) for k in lowered.to_pylist()]


class PerfectHash:
    """Slots 0 to n - 1 for n different keys of two 64-bit words, without gaps."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        counts = [np.bitwise_count(bits).astype(np.int64) for bits in levels]
        ends = np.cumsum([0, *(c.sum() for c in counts)])
        self._ranks = [before + np.cumsum(c) - c for before, c in zip(ends, counts)]

    @staticmethod
    def _place(low: np.ndarray, high: np.ndarray, level: int, bits: int) -> np.ndarray:
        mixed = low ^ (high + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return (mixed ^ mixed >> np.uint64(31)) % np.uint64(bits)

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray) -> PerfectHash:
        levels = []
        while len(low):
            words = -(-SPARE * len(low) // 64)
            place = cls._place(low, high, len(levels), 64 * words)
            alone = np.bincount(place.astype(np.int64), minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            again = ~alone[place.astype(np.int64)]
            low, high = low[again], high[again]
        return cls(levels)

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Slot of each key; any slot, or -1, for others."""
        out, open_ = np.full(len(low), -1, np.int64), np.arange(len(low))
        for level, (bits, ranks) in enumerate(zip(self.levels, self._ranks)):
            place = self._place(low[open_], high[open_], level, 64 * len(bits))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            hit = (bits[word] >> bit & np.uint64(1)).astype(bool)
            below = bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = ranks[word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
        return out


def _halves(hashes: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(hashes.to_pylist()), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


SHARD = "shard int, salts int, words array<int>, bits binary, prints binary, docs binary, keepers binary"


def _build_shard(most_probes: int):
    """One row: the levels of the perfect hash and the arrays that it indexes."""

    def run(rows: pa.Table) -> pa.Table:
        low, high = _halves(rows["hash"])
        found = PerfectHash.build(low, high)
        slot = found.slots(low, high)
        prints, docs, keepers = (np.empty(len(low), t) for t in (np.uint64, np.uint32, np.int64))
        prints[slot] = high
        docs[slot] = np.minimum(rows["n_docs"].to_numpy(), 2**32 - 1)
        keepers[slot] = rows["keeper"].to_numpy()
        salts = 1 + int(rows["n_rows"].to_numpy().sum()) // most_probes
        row = {
            "shard": pa.array([rows["shard"][0].as_py()], pa.int32()),
            "salts": pa.array([salts], pa.int32()),
            "words": pa.array([[len(b) for b in found.levels]], pa.list_(pa.int32())),
            "bits": [b"".join(b.tobytes() for b in found.levels)],
        }
        return pa.table(row | {n: [a.tobytes()] for n, a in (("prints", prints), ("docs", docs), ("keepers", keepers))})

    return run


def _probe(min_docs: int):
    """The rows whose line goes from their document."""

    def run(rows: pa.Table, shard: pa.Table) -> pa.Table:
        rows = rows.select(["hash", *ROW])
        if not rows.num_rows or not shard.num_rows:
            return rows.slice(0, 0)
        held = shard.slice(0, 1).to_pylist()[0]
        levels = np.split(np.frombuffer(held["bits"], np.uint64), np.cumsum(held["words"])[:-1])
        prints, docs, keepers = (
            np.frombuffer(held[n], t) for n, t in (("prints", np.uint64), ("docs", np.uint32), ("keepers", np.int64))
        )
        low, high = _halves(rows["hash"])
        slot = PerfectHash(levels).slots(low, high)
        known = (slot >= 0) & (prints[slot] == high) & (docs[slot] >= min_docs)
        doc_id = rows["doc_id"]
        own = pc.fill_null(doc_id, 0).to_numpy() == keepers[slot]
        own &= doc_id.is_valid().to_numpy()
        return rows.filter(pa.array(known & ~own))

    return run


def _hashes(docs: DataFrame, min_length: int) -> DataFrame:
    """(hash, doc_id, _a, _b): every different long line of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text"), [batch.column(c) for c in ROW]
            for begin, end in slices(texts, SLICE):
                _, sizes, long, hashes = cut(texts.slice(begin, end - begin), min_length)
                of = np.repeat(np.arange(begin, end), sizes)[long].tolist()
                once = list(dict.fromkeys(zip(of, hashes)))
                at = pa.array([i for i, _ in once], pa.int64())
                columns = [pa.array([h for _, h in once], pa.binary()), *(c.take(at) for c in ids)]
                yield pa.RecordBatch.from_arrays(columns, ["hash", *ROW])

    return docs.select("text", *ROW).mapInArrow(run, "hash binary, doc_id long, _a long, _b long")


def _rebuilt(docs: DataFrame, min_length: int) -> DataFrame:
    """Texts without the lines whose hashes are in `_gone`, with the numbers of lines."""
    fields = [f for f in docs.schema if f.name not in ("text", "_gone")]
    names = [f.name for f in fields]
    more = [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lost = batch.column("text"), batch.column("_gone")
            for begin, end in slices(texts, SLICE):
                lines, sizes, long, hashes = cut(texts.slice(begin, end - begin), min_length)
                gone = [set(x) if x else () for x in lost.slice(begin, end - begin).to_pylist()]
                of = np.repeat(np.arange(end - begin), sizes)
                drop = [i for i, d, h in zip(long.tolist(), of[long].tolist(), hashes) if h in gone[d]]
                stay = np.ones(len(lines), bool)
                stay[drop] = False
                left = np.bincount(of[stay], minlength=end - begin)
                offsets = pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32())
                kept = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.filter(pa.array(stay))), "\n")
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n).slice(begin, end - begin) for n in names), kept]
                    + [pa.array(sizes, pa.int64()), pa.array(sizes - left, pa.int64())],
                    [*names, "text", "n_lines", "n_dropped"],
                )

    return docs.select(*names, "text", "_gone").mapInArrow(run, T.StructType(fields + more))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(hash, n_docs, n_rows, keeper) of the lines that enough documents hold."""
    counted = lines.groupBy("hash").agg(
        F.count_distinct("doc_id").alias("n_docs"), F.count("*").alias("n_rows"), F.max("doc_id").alias("keeper")
    )
    return counted.where(F.col("n_docs") >= min_docs)


def dedup(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with their text without repeated lines, and n_lines (before) and n_dropped."""
    if min_docs < 1:
        raise ValueError("a line is repeated from one document on")
    docs = docs.drop("n_lines", "n_dropped")
    # a row is told by its doc_id and text; rows equal in both lose the same lines
    given = aside(docs, "doc_id", "text").withColumns(
        {
            "doc_id": F.col("doc_id").cast("long"),
            "_a": F.xxhash64(F.col("text")),
            "_b": F.xxhash64(F.lit(1), F.col("text")),
        }
    )
    lines = cut_lineage(_hashes(given, min_length))
    repeated = cut_lineage(repeated_lines(lines, min_docs))
    shards = max(1, -(-repeated.count() // SHARD_KEYS), -(-lines.count() // SHARD_PROBES))
    shard = F.pmod(F.xxhash64("hash"), F.lit(shards)).cast("int")
    index = cut_lineage(repeated.withColumn("shard", shard).groupBy("shard").applyInArrow(_build_shard(SHARD_PROBES), SHARD))
    crowded = index.where("salts > 1").select(F.col("shard").alias("_shard"), "salts")
    sent = lines.withColumns({"shard": shard, "_n": F.monotonically_increasing_id()})
    sent = sent.join(crowded, F.col("shard") == F.col("_shard"), "left")
    sent = sent.select("hash", *ROW, "shard", F.pmod("_n", F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    found = sent.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
    found = found.applyInArrow(_probe(min_docs), "hash binary, doc_id long, _a long, _b long")
    gone = cut_lineage(found.groupBy(*ROW).agg(F.collect_set("hash").alias("_gone")))  # at most a text's own lines
    of = gone.select(F.col("doc_id").alias("_doc"), F.col("_a").alias("_a2"), F.col("_b").alias("_b2"), "_gone")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_a") == F.col("_a2")) & (F.col("_b") == F.col("_b2"))
    joined = given.join(of, same, "left").drop("_doc", "_a2", "_b2", "_a", "_b")
    return restored(_rebuilt(joined, min_length), docs, "n_lines", "n_dropped")
