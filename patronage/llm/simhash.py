"""SimHash near-duplicates by one-wildcard signatures of two segments.

A fingerprint has 64 bits. Two that differ in at most two bits have one of their two 32-bit segments
differ in at most one. Every distinct fingerprint is indexed under its 64 signatures: a segment with
one bit left out. Equal signatures meet in one sorted scan, which is the equality join, and their
fingerprints are compared in full. A signature that more than `most_bucket` distinct fingerprints
share isn't compared pair by pair: its fingerprints are indexed once more, under all signatures with
two bits of the whole left out, whose rows are linked as a chain, since they can't differ elsewhere.

Defined results: a text without words (null, empty, white space) has fingerprint zero and is linked
like any other; equal fingerprints are linked; null doc_ids get a component but never name one;
repeated rows stay repeated; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.components import LINKS, LinkBuffer, components
from patronage.llm.frames import aside, restored
from patronage.llm.tokens import slices
from patronage.session import cut_lineage

SHINGLE = 3
SEED = 42
BITS = 2
MOST_BUCKET = 4096
#: Shingles whose bits are counted at once.
COUNTED = 200_000
#: Bytes of text whose shingles are hashed at once.
SLICE = 3_000_000


def _hashes(text: str, shingle: int) -> list[int]:
    """XXH64 of all runs of `shingle` words, or of the whole sequence if it is shorter."""
    words = text.encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(begins.tolist(), ends[shingle - 1 :].tolist())]


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes: a bit is set if over half of a run have it set.
    An empty run gives zero. Long runs are counted in parts."""
    out = np.zeros(len(sizes), np.uint64)
    run = np.flatnonzero(sizes)
    if not len(run):
        return out
    counts = np.zeros((len(run), 64), np.int64)
    ends = np.cumsum(sizes[run])
    of = np.repeat(np.arange(len(run)), sizes[run])
    for i in range(0, len(hashes), COUNTED):
        part = hashes[i : i + COUNTED].astype(">u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        first = of[i : i + COUNTED]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(first)) + 1])
        counts[first[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    over = counts * 2 > np.diff(np.concatenate([[0], ends]))[:, None]
    out[run] = np.packbits(over, axis=1).view(">u8").reshape(-1)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every document; fp is the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for begin, end in slices(texts, SLICE):
                found = [_hashes(t, shingle) if t else [] for t in texts.slice(begin, end - begin).to_pylist()]
                sizes = np.array([len(f) for f in found], np.int64)
                flat = np.fromiter((h for f in found for h in f), np.uint64, int(sizes.sum()))
                fps = pa.array(_majority(flat, sizes).view(np.int64))
                yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin), fps], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _canonical(xor: np.ndarray, wildcard: np.ndarray) -> np.ndarray:
    """Whether a pair should be reported under this signature, of all that it shares."""
    low = xor & np.uint64(0xFFFFFFFF)
    in_low = np.bitwise_count(low) <= 1
    segment = np.where(in_low, low, xor >> np.uint64(32))
    first = np.where(in_low, 0, 32)
    bit = np.bitwise_count(np.maximum(segment, 1).astype(np.uint64) - np.uint64(1)).astype(np.int64)
    return wildcard == first + np.where(segment == 0, 0, bit)


def _scan(most_bits: int, most_bucket: int):
    """Over rows sorted by signature: links as (a, b); a fingerprint of a too large bucket as (fp, fp)."""

    def links(key: np.ndarray, fp: np.ndarray, held: LinkBuffer) -> np.ndarray:
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([starts, [len(key)]]))
        left = np.repeat(np.cumsum(size), size) - np.arange(len(key)) - 1  # of the same signature
        wide = np.repeat(size, size) > most_bucket
        at, step = np.flatnonzero((left >= 1) & ~wide), 1
        while len(at):
            xor = (fp[at] ^ fp[at + step]).view(np.uint64)
            near = np.bitwise_count(xor) <= most_bits
            hit = at[near]
            hit = hit[_canonical(xor[near], key[hit] >> 32)]
            held.add(fp[hit], fp[hit + step])
            step += 1
            at = at[left[at] >= step]
        return fp[wide]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = LinkBuffer()
        key = fp = np.empty(0, np.int64)
        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy()])
            fp = np.concatenate([fp, batch.column("fp").to_numpy()])
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if cut > 100_000 or len(key) - cut > most_bucket:
                yield from itself(links(key[:cut], fp[:cut], held))
                key, fp = key[cut:], fp[cut:]
            if len(key) > most_bucket and key[0] == key[-1]:  # what more of it comes is wide as well
                yield from itself(fp[most_bucket + 1 :])
                key, fp = key[: most_bucket + 1], fp[: most_bucket + 1]
        if len(key):
            yield from itself(links(key, fp, held))
        yield from held.batches()

    def itself(fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(fp):
            own = pa.array(np.unique(fp))
            yield pa.RecordBatch.from_arrays([own, own], ["a", "b"])

    return run


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by signature: each fingerprint linked to the one before it."""
    held, last = LinkBuffer(), [np.empty(0, np.int64)] * 3
    for batch in batches:
        last = [np.concatenate([a[-1:], batch.column(c).to_numpy()]) for a, c in zip(last, ("pair", "key", "fp"))]
        pair, key, fp = last
        same = np.flatnonzero((key[1:] == key[:-1]) & (pair[1:] == pair[:-1]))
        held.add(fp[same], fp[same + 1])
    yield from held.batches()


def _scanned(index: DataFrame, scan, *key: str) -> DataFrame:
    return index.repartition(*key).sortWithinPartitions(*key, "fp").mapInArrow(scan, LINKS)


def links(fps: DataFrame, most_bits: int = BITS, most_bucket: int = MOST_BUCKET) -> DataFrame:
    """Links (a, b) that connect all of the distinct fingerprints that differ in at most two bits."""
    if most_bits not in (1, 2):
        raise ValueError("two segments serve one or two differing bits")
    bit = F.col("bit")
    part = F.when(bit < 32, F.col("fp")).otherwise(F.shiftrightunsigned("fp", 32)).bitwiseAND(F.lit(0xFFFFFFFF))
    without = part.bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, bit % 32)")))
    index = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    index = index.select(F.shiftleft(bit.cast("long"), 32).bitwiseOR(without).alias("key"), "fp")
    found = cut_lineage(_scanned(index, _scan(most_bits, most_bucket), "key"))
    wide = found.where("a = b").select(F.col("a").alias("fp")).distinct()
    near = found.where("a <> b")
    if not found.where("a = b").head(1):
        return near
    # signatures with every one or two bits of the whole left out, told apart by which they are
    bits = F.explode(F.sequence(F.lit(0), F.lit(63)))
    pairs = wide.select("fp", bits.alias("i"))
    if most_bits == 2:
        pairs = pairs.where("i < 63").select("fp", "i", F.explode(F.sequence(F.col("i") + 1, F.lit(63))).alias("j"))
    else:
        pairs = pairs.withColumn("j", F.col("i"))
    mask = F.expr("shiftleft(1L, i) | shiftleft(1L, j)")
    both = pairs.select(
        (F.col("i") * 64 + F.col("j")).alias("pair"), F.col("fp").bitwiseAND(F.bitwise_not(mask)).alias("key"), "fp"
    )
    return near.unionAll(_scanned(both, _chain, "pair", "key"))


def _groups(of_doc: DataFrame, most_bits: int) -> DataFrame:
    """(fp, component, component_id) of the different fingerprints of (doc_id, fp): a number of the
    group, and the smallest doc_id in it, null where none of it has one."""
    fps = cut_lineage(of_doc.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = components(links(fps.select("fp"), most_bits))
    known = cut_lineage(
        fps.join(joined, F.col("fp") == F.col("node"), "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        )
    )
    least = cut_lineage(known.groupBy("component").agg(F.min("least").alias("component_id")))
    return cut_lineage(known.select("fp", "component").join(least, "component").select("fp", "component", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every document; component_id is the smallest doc_id reachable."""
    of_doc = cut_lineage(fingerprints(docs, shingle))
    return of_doc.join(_groups(of_doc, most_bits), "fp").select("doc_id", "fp", "component_id")


def digests(found: DataFrame) -> DataFrame:
    """The result with the fingerprint as 16 hexadecimal digits."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = BITS) -> DataFrame:
    """The document with the smallest doc_id of each group, with all of the input's columns; of rows
    that repeat a doc_id one stays. Of a group in which no row has a doc_id one row stays, whichever
    Spark numbers first; any other row without doc_id goes."""
    of_doc = cut_lineage(fingerprints(docs, shingle))
    groups = _groups(of_doc, most_bits)
    found = of_doc.join(groups, "fp").where("doc_id = component_id")
    kept = found.groupBy("doc_id").count()
    kept = cut_lineage(kept.select(F.col("doc_id").alias("_kept"), (F.col("count") > 1).alias("_again")))
    given = aside(docs, "doc_id")
    # one plan at every size: the ids that stay grow with the input, so they aren't broadcast
    out = given.join(kept.hint("shuffle_hash"), F.col("doc_id") == F.col("_kept"))
    if kept.where("_again").head(1):
        out = out.where("not _again").unionByName(out.where("_again").dropDuplicates(["doc_id"]))
    out = restored(out, docs)
    nameless = groups.where("component_id is null")
    if not nameless.head(1):
        return out
    # numbers in place of the ids that are missing
    rows = aside(docs, "doc_id", "text").where("doc_id is null")
    rows = cut_lineage(rows.withColumn("_number", F.monotonically_increasing_id()))
    numbered = fingerprints(rows.select(F.col("_number").alias("doc_id"), "text"), shingle)
    first = numbered.join(nameless, "fp").groupBy("component").agg(F.min("doc_id").alias("_first"))
    rest = rows.join(first.select("_first"), F.col("_number") == F.col("_first"))
    return out.unionByName(restored(rest, docs))
