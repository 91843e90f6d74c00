"""Byte-level BPE by a prefix-sharing trie, and decoding.

The distinct words of a task's texts go into one trie of bytes. Each node keeps the last token of the
encoding of its prefix; the token before it is the state of the node where that token begins. A
node's state follows from its ancestors' alone: it is the one token that ends the prefix, and that
could stand behind the last token of the node where it begins. Two tokens can stand together if no
merge across their border would have come before the merges that made them. So the encoding of a
prefix that many words share is computed once, and a word's ids are read off on the way to the root.
The tokens that end a prefix come, longest first, from an automaton over all tokens' bytes, whose state
is part of the node's.

The ids of known pieces live as long as a worker, up to a bound on their size; emptying them changes no
result.

Defined results: a null text is empty and has no ids; special tokens that stand in a text get their
own ids; other columns, null doc_ids and repeated rows pass through unchanged.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.tokens import PieceCache, byte_letters, gather, list_sizes, slices, sums
from patronage.llm.worker import keep

MOST_PAIRS = 300_000
MOST_BYTES = 24_000_000
#: Bytes of text that are encoded, and ids that are decoded at once.
SLICE, DECODED = 4_000_000, 500_000

#: How the vocabulary's file cuts text into words, and the white space it knows.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACES = r"\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def marks() -> Iterator[str]:
    """Strings that can part the pieces of a slice; the first one that no text holds is taken."""
    yield "\x00"
    yield from (f"\ue000{n}\ue001" for n in count())


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _bytes_of(spec: dict) -> tuple[dict[int, bytes], dict[str, int]]:
    """Every token's bytes by id, and the special tokens' ids."""
    letters = byte_letters()
    own = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return own | {i: t.encode() for t, i in special.items()}, special


class Vocabulary:
    """Tokens as bytes, their merges, and which tokens can stand together."""

    def __init__(self, path: str):
        spec = _read(path)
        self.bytes_of, self.special = _bytes_of(spec)
        ids = spec["model"]["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in enumerate(pairs)}
        self.made = {ids[a + b]: (r, ids[a], ids[b]) for r, (a, b) in reversed(list(enumerate(pairs)))}
        special = set(self.special.values())
        own = {b: i for i, b in self.bytes_of.items() if i not in special}
        # a token that its own bytes don't encode to never ends an encoding
        self.id_of = {b: i for b, i in own.items() if self._reached(i)}
        if missing := [n for n in range(256) if bytes([n]) not in self.id_of]:
            raise ValueError(f"no tokens for bytes {missing}")
        self.pairs: dict[int, bool] = {}  # answers of `together`

    def _reached(self, token: int) -> bool:
        made = self.made.get(token)
        return made is None or self._apart(made[1], made[2], made[0])

    def _apart(self, left: int, right: int, before: int) -> bool:
        """No merge of rank below `before` crosses the border while the two tokens are being made.

        Goes back in time: undoes the later of the two tokens' last merges (of two equal ones the
        right one, since equal merges run from left to right) and looks for an earlier merge of what
        then met at the border.
        """
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and rank < before:
                return False
            a, b = self.made.get(left), self.made.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[0] > b[0]:
                before, left = min(before, a[0]), a[2]
            else:
                before, right = min(before, b[0] + 1), b[1]

    def together(self, pair: int) -> bool:
        """Whether two tokens can stand together, given as left << 32 | right."""
        if len(self.pairs) > MOST_PAIRS:
            self.pairs.clear()
        known = self.pairs[pair] = self._apart(pair >> 32, pair & 0xFFFFFFFF, len(self.rank))
        return known


class Suffixes:
    """Which tokens end a text, byte by byte: an automaton over the tokens' bytes. A state stands for the
    longest end of the text that begins some token."""

    def __init__(self, id_of: dict[bytes, int]):
        self.next: dict[int, int] = {}  # state * 256 + byte
        self.token, self.size = [-1], [0]
        for text, token in id_of.items():
            state = 0
            for depth, byte in enumerate(text, 1):
                after = self.next.get(state * 256 + byte)
                if after is None:
                    after = self.next[state * 256 + byte] = len(self.token)
                    self.token.append(-1)
                    self.size.append(depth)
                state = after
            self.token[state] = token
        # the state of the longest proper end, and the longest token that is one
        self.shorter, self.rest = [0] * len(self.token), [0] * len(self.token)
        for depth, key, state in sorted((self.size[s], k, s) for k, s in self.next.items()):
            if depth > 1:
                end = self.shorter[state] = self.after(self.shorter[key >> 8], key & 255)
                self.rest[state] = end if self.token[end] >= 0 else self.rest[end]

    def after(self, state: int, byte: int) -> int:
        """The state behind one more byte."""
        found = self.next.get(state * 256 + byte)
        while found is None and state:
            state = self.shorter[state]
            found = self.next.get(state * 256 + byte)
        return found or 0


class Trie:
    """Words' bytes as a trie; each node knows the last token of its prefix, where that begins, and which
    tokens end there. Sorted words are the depth-first walk, on which only the nodes on the way to the
    current word are held."""

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary, self._suffixes = vocabulary, Suffixes(vocabulary.id_of)

    def encode(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words."""
        ends, pairs, together = self._suffixes, self._vocabulary.pairs, self._vocabulary.together
        step, shorter, token, size, rest = ends.next.get, ends.shorter, ends.token, ends.size, ends.rest
        deepest = max(map(len, words), default=0) + 1
        last, begin, state = [-1] * deepest, [0] * deepest, [0] * deepest  # by depth
        out, previous = {}, b""
        for word in sorted(words):
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            previous = word
            at = state[shared]
            for depth, byte in enumerate(word[shared:], shared + 1):
                found = step(at * 256 + byte)
                while found is None:
                    at = shorter[at]
                    found = step(at * 256 + byte)
                state[depth] = at = found
                end = found if token[found] >= 0 else rest[found]
                while start := depth - size[end]:
                    pair = last[start] << 32 | token[end]
                    fits = pairs.get(pair)
                    if together(pair) if fits is None else fits:
                        break
                    end = rest[end]
                last[depth], begin[depth] = token[end], start
            ids, depth = [], len(word)
            while depth:
                ids.append(last[depth])
                depth = begin[depth]
            out[word] = ids[::-1]
        return out


class Cutter:
    """Pieces of texts: cut before each single space between other characters, where no word goes on."""

    def __init__(self, special: list[str]):
        self._special = special
        spaces = SPACES.replace(r"\x{", r"\u{")
        self._odd = f"[{SPACES}][{SPACES}]|^[{SPACES}]|[{SPACES}]$"
        one = regex.sub(r"\\u\{([0-9a-f]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", spaces)
        self._odd_pieces = regex.compile(rf" ?[^{one}]+|[{one}]+(?![^{one}])|[{one}]+")
        self._parts = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def _own(self, text: str, mark: str) -> str:
        """Pieces of a text with runs of white space or special tokens, parted by the mark."""
        parts = self._parts.split(text) if self._parts else [text]
        return mark.join(
            mark.join([p] if p in self._special else self._odd_pieces.findall(p)) for p in parts if p
        )

    def __call__(self, texts: pa.Array) -> pa.Array:
        mark = next(m for m in marks() if not pc.any(pc.match_substring(texts, m)).as_py())
        odd = pc.match_substring_regex(texts, self._odd)
        for special in self._special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        marked = pc.replace_substring(texts, " ", mark + " ")
        where = pc.fill_null(odd, False)
        if pc.any(where).as_py():
            own = [self._own(t, mark) for t in texts.filter(where).to_pylist()]
            marked = pc.replace_with_mask(marked, where, pa.array(own, marked.type))
        return pc.split_pattern(marked, mark)


def byte_cache(path: str) -> PieceCache:
    """Cache over a byte-level vocabulary file, kept by the worker."""
    return keep(("bytes", path), lambda: _byte_cache(path))


def _byte_cache(path: str) -> PieceCache:
    vocabulary = Vocabulary(path)
    trie, words = Trie(vocabulary), regex.compile(WORDS)

    def encode(fresh: list[str]) -> list[list[int]]:
        cut = [[] if p in vocabulary.special else [w.encode() for w in words.findall(p)] for p in fresh]
        known = trie.encode(list({w for ws in cut for w in ws}))
        return [
            [vocabulary.special[p]] if p in vocabulary.special else [i for w in ws for i in known[w]]
            for p, ws in zip(fresh, cut)
        ]

    return PieceCache(Cutter(list(vocabulary.special)), encode, MOST_BYTES)


@lru_cache(maxsize=1)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, with start and size by id."""
    of = _bytes_of(_read(path))[0]
    rows = [of.get(i, b"") for i in range(max(of) + 1)]
    size = np.array([len(r) for r in rows], np.int64)
    return np.frombuffer(b"".join(rows), np.uint8), np.cumsum(size) - size, size


def _with_column(df: DataFrame, source: str, name: str, kind: T.DataType, make) -> DataFrame:
    """The frame with one more column, made slice by slice out of an Arrow column."""
    schema = T.StructType([*(f for f in df.schema if f.name != name), T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(source)
            kept = [n for n in batch.schema.names if n != name]
            for begin, end in make.ranges(values):
                part = batch.slice(begin, end - begin)
                columns = [part.column(n) for n in kept]
                yield pa.RecordBatch.from_arrays([*columns, make(part.column(source))], [*kept, name])

    return df.mapInArrow(run, schema)


class _Encode:
    def __init__(self, path: str):
        self._path = path

    @staticmethod
    def ranges(texts: pa.Array) -> Iterator[tuple[int, int]]:
        return slices(texts, SLICE)

    def __call__(self, texts: pa.Array) -> pa.Array:
        flat, sizes = byte_cache(self._path).ids(texts)
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), flat)


class _Decode:
    def __init__(self, path: str):
        self._path = path

    @staticmethod
    def ranges(lists: pa.Array) -> Iterator[tuple[int, int]]:
        ends, begin = np.cumsum(list_sizes(lists)), 0
        while begin < len(ends):
            held = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, held + DECODED)))
            yield begin, end
            begin = end

    def __call__(self, lists: pa.Array) -> pa.Array:
        flat, start, size = _token_bytes(self._path)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        of_text = sums(size[ids], list_sizes(lists))
        whole = gather(flat, start[ids], size[ids]).tobytes()
        ends = np.cumsum(of_text).tolist()
        begins = [0, *ends[:-1]]
        return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(begins, ends)], pa.string())


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The documents with their ids in one more column; a column of that name is replaced."""
    return _with_column(docs, text, ids, T.ArrayType(T.IntegerType()), _Encode(vocabulary))


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The documents with the text that their ids stand for; bytes that are no UTF-8 become U+FFFD."""
    return _with_column(docs, ids, text, T.StringType(), _Decode(vocabulary))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, number of ids, and SHA-256 of the ids and of the decoded text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
