"""Substring joins as equi-joins.

`longest_names` puts every name under an anchor, its first four bytes or fewer. A text is read once,
whatever the lengths of the names: a table of fixed size says at which places of it an anchor may stand
and how long its names are, another one which hashes whole names have. Only pieces that both let through
meet the names, each once for a run of the text's bytes, in a hash join on the whole piece.

`like_matches` joins the pieces of short values that are as long as some pattern's literal part.
In both, work grows with the texts, not with texts x names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# The columns that name a sector or an area.
NAME_COLUMNS = [
    ("sector", "HPSN_MCT_ZCD_NM"),
    ("area", "MCT_SIGUNGU_NM"),
    ("area", "HPSN_MCT_BZN_CD_NM"),
]
_ESCAPE = "\u0001"
# Letters of a text that are searched at once.
BLOCK = 64
#: Bytes of an anchor, and places of a table that names are found by, as a power of two.
ANCHOR, TABLE_BITS = 4, 18
#: Odd base of the hashes of pieces, modulo 2**64.
BASE = 0xD1342543DE82EF95
#: Bytes of text that are worked on at once inside a task.
SLICE = 250_000


def _pieces(df: DataFrame, text: Column, lengths: Column, keep: list[str]) -> DataFrame:
    """The different pieces of each block of a text that have one of the lengths.

    Finding a place in a long text means walking there from its start, so a text is cut once into
    letters, and these into blocks that overlap by the longest piece; pieces are taken inside the
    short blocks. The work grows with the text's length, not with its square.
    """
    letters = "regexp_extract_all(_text, '(?s).', 0)"
    starts = f"sequence(1, greatest(size(letters), 1), {BLOCK})"
    block = f"array_join(slice(letters, s, {BLOCK} + array_max(_lengths) - 1), '')"
    blocks = f"transform(array({letters}), letters -> transform({starts}, s -> {block}))[0]"
    places = f"sequence(1, least({BLOCK}, char_length(_block) - n + 1))"
    inside = f"transform({places}, p -> substring(_block, p, n))"
    fitting = "filter(_lengths, n -> n > 0 AND n <= char_length(_block))"
    empty = "if(array_contains(_lengths, 0), array(''), cast(array() AS array<string>))"  # is in every text
    pieces = f"array_distinct(concat({empty}, flatten(transform({fitting}, n -> {inside}))))"
    texts = df.select(*keep, text.alias("_text"), lengths.alias("_lengths")).filter("size(_lengths) > 0")
    cut = texts.select(*keep, "_lengths", F.explode(F.expr(blocks)).alias("_block"))
    return cut.select(*keep, F.explode(F.expr(pieces)).alias("_piece"))


def _lengths(names: DataFrame, name: Column) -> Column:
    """The name lengths that occur, as a scalar subquery."""
    return names.agg(F.sort_array(F.collect_set(F.length(name)))).scalar()


def vocabulary(stg_store: DataFrame) -> DataFrame:
    """Sector and area names of the shops: a name list per column, put together."""
    lists = [
        stg_store.filter(F.col(source).isNotNull())
        .select(F.col(source).alias(kind))
        .distinct()
        for kind, source in NAME_COLUMNS
    ]
    both = lists[0].unionByName(lists[1], allowMissingColumns=True)
    return both.unionByName(lists[2], allowMissingColumns=True)


def name_list(stg_store: DataFrame) -> DataFrame:
    """The same names as distinct (kind, name) rows, off one scan."""
    entries = [
        F.struct(F.lit(kind).alias("kind"), F.col(source).alias("name"))
        for kind, source in NAME_COLUMNS
    ]
    return stg_store.select(F.inline(F.array(*entries))).filter(F.col("name").isNotNull()).distinct()


def _grams(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(size, the piece of that size at every place as a number) for 1 to ANCHOR bytes."""
    grams = data.astype(np.uint32)
    yield 1, grams
    for size in range(2, ANCHOR + 1):
        grams = grams[:-1] << np.uint32(8) | data[size - 1 :]
        yield size, grams


def _places(grams: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Place of each piece in the anchors' table."""
    return (grams + np.uint32(size * 0x01000193)) * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base, modulo 2**64."""
    return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])


def _sums(data: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Sums of the bytes before each place, byte by byte times a power; differences of them are hashes of pieces."""
    return np.r_[np.uint64(0), np.cumsum(data * powers[: len(data)])]


def _whole_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Place of each hash in the table of whole names."""
    return hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)


def _bit(length: int) -> np.uint64:
    return np.uint64(1 << length % 64)


def _tables(names: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """For each place the bits of the lengths of names whose anchor has it, for each place whether a whole name
    has it, and the lengths that occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for name in batch.column(0).to_pylist():
                data = np.frombuffer(name.encode(), np.uint8)
                size = min(len(data), ANCHOR)
                gram = dict(_grams(data[:ANCHOR]))[size]
                whole = _sums(data, _powers(BASE, len(data)))[-1:]
                rows.add((0, int(_places(gram, size, bits)[0]), int(_bit(len(data)).view(np.int64))))
                rows.add((1, int(_whole_places(whole, bits)[0]), 0))
                rows.add((2, len(data), 0))
            columns = [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "place", "bits"])

    found = names.select("name").mapInArrow(run, "part long, place long, bits long")
    found = found.groupBy("part", "place").agg(F.bit_or("bits").alias("bits")).toArrow()
    part, place, mask = (found.column(c).to_numpy() for c in found.column_names)
    anchors, whole = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, bool)
    anchors[place[part == 0]] = mask[part == 0].view(np.uint64)
    whole[place[part == 1]] = True
    return anchors, whole, sorted(place[part == 2].tolist())


def _binaries(data: np.ndarray) -> pa.Array:
    """The rows of a table of bytes."""
    kind, rows = pa.binary(data.shape[1]), pa.py_buffer(np.ascontiguousarray(data))
    return pa.Array.from_buffers(kind, len(data), [None, rows]).cast(pa.binary())


def _candidates(
    texts: DataFrame, key: str, text: str, anchors: np.ndarray, whole: np.ndarray, lengths: list[int], most: int
) -> DataFrame:
    """(key, piece): the pieces of each text that the tables take for names, each once a run of bytes."""
    bits = len(whole).bit_length() - 1
    hot, longest = anchors != 0, max(lengths, default=0)
    of_size = {s: [n for n in lengths if min(n, ANCHOR) == s] for s in range(1, ANCHOR + 1)}

    def found(data: np.ndarray, ends: np.ndarray, powers: np.ndarray, back: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array]]:
        """(text, piece) of what begins in the first bytes, the last names reaching beyond them."""
        sums = _sums(data, powers) if longest > ANCHOR else None
        for size, grams in _grams(data[: most + ANCHOR - 1]):
            if not of_size[size]:
                continue
            grams = grams[:most]
            places = _places(grams, size, bits)
            at = np.flatnonzero(hot[places])
            of = np.searchsorted(ends, at, side="right")
            room, near = ends[of] - at, anchors[places[at]]  # not across two texts
            for length in of_size[size]:
                fits = np.flatnonzero((near & _bit(length) != 0) & (room >= length))
                if length == size:  # the anchor is the name
                    pairs = np.unique(of[fits] << 32 | grams[at[fits]])
                    pieces = (pairs & 0xFFFFFFFF).astype(">u4").view(np.uint8).reshape(-1, ANCHOR)
                    yield pairs >> 32, _binaries(pieces[:, ANCHOR - size :])
                    continue
                starts = at[fits]
                hashes = (sums[starts + length] - sums[starts]) * back[starts]
                taken = whole[_whole_places(hashes, bits)]
                if taken.any():
                    pieces = _binaries(np.lib.stride_tricks.sliding_window_view(data, length)[starts[taken]])
                    each = pa.table([pa.array(of[fits][taken]), pieces], ["of", "piece"])
                    each = each.group_by(["of", "piece"], use_threads=False).aggregate([])
                    yield each["of"].to_numpy(), each["piece"].combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, back = (_powers(base, most + longest) for base in (BASE, pow(BASE, -1, 1 << 64)))
        for batch in batches:
            keys, column = batch.column(0), batch.column(1).fill_null("").cast(pa.large_binary())
            bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
            ends = bounds[1:] - bounds[0]
            for begin in range(0, len(data), most):
                rows = list(found(data[begin : begin + most + longest], ends - begin, powers, back))
                if rows:
                    at = pa.array(np.concatenate([r[0] for r in rows]))
                    pieces = pa.concat_arrays([r[1] for r in rows])
                    yield pa.RecordBatch.from_arrays([keys.take(at), pieces], ["_key", "_piece"])

    kind = dict(texts.dtypes)[key]
    return texts.select(key, text).mapInArrow(run, f"_key {kind}, _piece binary")


def longest_names(
    texts: DataFrame, key: str, text: str, names: DataFrame, table_bits: int = TABLE_BITS, slice_bytes: int = SLICE
) -> DataFrame:
    """Per text and kind of name the longest name the text contains; equal lengths in name order.

    ``names`` has distinct rows (kind, name). The driver sees two tables of fixed size and the lengths of
    names; the names are joined, broadcast or not, as Spark's size check finds.
    Texts without any match are left out.
    """
    names = cut_lineage(names.filter(F.col("name") != "").select("kind", "name"))
    pieces = _candidates(texts, key, text, *_tables(names, table_bits), slice_bytes)
    hits = pieces.join(names, F.col("_piece") == F.encode("name", "UTF-8"))
    first = F.min_by("name", F.struct(-F.length("name"), F.col("name")))
    return hits.groupBy(F.col("_key").alias(key), "kind").agg(first.alias("name"))


def _like_pattern(param: Column) -> Column:
    """The parameter as a pattern in which only ``%`` and ``_`` are special, escaped by a control
    character in place of the backslash."""
    escaped = F.regexp_replace(param, r"\\([%_])", _ESCAPE + "$1")
    return F.regexp_replace(escaped, r"\\(.)", "$1")


def like_matches(params: DataFrame, values: DataFrame) -> DataFrame:
    """(param, value) pairs where the value contains the parameter, ignoring case.

    ``%`` and ``_`` in a parameter act as wildcards. The join is on the longest literal part of the
    parameter; the whole pattern is then checked on the candidates. Both inputs have one column
    (param, value) and are made distinct first.
    """
    patterns = (
        params.filter(F.col("param").isNotNull())
        .distinct()
        .withColumn("_pattern", F.lower(_like_pattern(F.col("param"))))
        .withColumn("_parts", F.split("_pattern", f"[%_{_ESCAPE}]"))
    )
    by_length = F.array_sort("_parts", lambda a, b: F.length(b) - F.length(a))
    keyed = patterns.select("param", "_pattern", F.element_at(by_length, 1).alias("_part"))
    known = values.filter(F.col("value").isNotNull()).distinct()
    pieces = _pieces(known, F.lower("value"), _lengths(keyed, F.col("_part")), ["value"]).distinct()
    candidates = pieces.join(keyed, F.col("_piece") == F.col("_part"))
    whole = F.concat(F.lit("%"), F.col("_pattern"), F.lit("%"))
    matched = candidates.filter(F.ilike(F.col("value"), whole, F.lit(_ESCAPE)))
    return matched.select("param", "value").distinct()
