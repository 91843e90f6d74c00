"""Token ids of whole texts inside Arrow tasks: each distinct piece of text is encoded once a task.

`PieceCache` is shared by the operators on tokens. A cutter splits texts at places where the
vocabulary joins nothing, Arrow numbers the distinct pieces of a slice, and the ids of a text are put
together with one gather out of flat arrays. The pieces are kept as one Arrow array and forgotten when
they and their ids take more than `MOST_BYTES`, which bounds a worker's memory and changes no result.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from patronage.llm.worker import keep

#: Bytes of pieces and their ids that a worker keeps.
MOST_BYTES = 48_000_000
#: New pieces that are encoded at once.
LEARNED = 100_000
#: Bytes of text that are worked on at once inside a task.
SLICE_BYTES = 12_000_000
#: Pieces that go to the tokenizer in one call.
JOINED = 64


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts with about `most` bytes each; a longer text stands alone."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.int64)
    begin, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > begin and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(size):
        yield begin, len(size)


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + size] one after another."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    kind = np.int32 if max(ends[-1], len(flat)) < 2**31 else np.int64  # half the memory, as a rule
    return flat[np.arange(ends[-1], dtype=kind) + np.repeat((start - (ends - size)).astype(kind), size)]


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each of the consecutive runs of `sizes` values."""
    ends = np.concatenate([[0], np.cumsum(values)])
    at = np.concatenate([[0], np.cumsum(sizes)])
    return np.diff(ends[at])


def list_sizes(lists: pa.Array) -> np.ndarray:
    """Lengths of the lists, 0 for null."""
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), np.int64)


class PieceIndex:
    """Numbers of distinct pieces, kept as one Arrow array. `learn` is told of new pieces in the order of
    their numbers, `forget` when all numbers are void, which is when pieces and what was learned of them
    take `most` bytes; `taken` says how many the latter are."""

    def __init__(
        self,
        cut: Callable[[pa.Array], pa.Array],
        learn: Callable[[list[str]], None],
        forget: Callable[[], None],
        taken: Callable[[], int],
        most: int = MOST_BYTES,
    ):
        self._cut, self._learn, self._forget, self._taken, self._most = cut, learn, forget, taken, most
        self._known: pa.Array | None = None

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of every piece of the texts in order, and how many pieces each text has."""
        cut = self._cut(texts)
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary
        if self._known is None or self._known.nbytes + self._taken() > self._most:
            self._known = distinct.slice(0, 0)
            self._forget()
        place = pc.index_in(distinct, value_set=self._known)
        number = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = number < 0
        if new.any():
            fresh = distinct.filter(pa.array(new))
            for i in range(0, len(fresh), LEARNED):
                self._learn(fresh.slice(i, LEARNED).to_pylist())
            number[new] = len(self._known) + np.arange(len(fresh))
            self._known = pa.concat_arrays([self._known, fresh])
        return number[coded.indices.to_numpy(zero_copy_only=False)], list_sizes(cut)


class PieceCache:
    """Ids of texts by the ids of their pieces.

    `cut` makes lists of pieces of an array of texts, `encode` the ids of each of the new pieces.
    """

    def __init__(
        self, cut: Callable[[pa.Array], pa.Array], encode: Callable[[list[str]], list], most: int = MOST_BYTES
    ):
        self._encode = encode
        self._index = PieceIndex(cut, self._learn, self._forget, self._bytes, most)

    def _bytes(self) -> int:
        return self._flat.nbytes + self._start.nbytes + self._size.nbytes

    def _forget(self) -> None:
        self._flat = np.empty(0, np.int32)
        self._start = np.empty(0, np.int64)
        self._size = np.empty(0, np.int64)

    def _learn(self, fresh: list[str]) -> None:
        ids = self._encode(fresh)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
        self._start = np.concatenate([self._start, len(self._flat) + np.cumsum(size) - size])
        self._size = np.concatenate([self._size, size])
        self._flat = np.concatenate([self._flat, flat])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of each text's ids; a null text has none."""
        at, pieces = self._index.numbers(texts)
        size = self._size[at]
        return gather(self._flat, self._start[at], size), sums(size, pieces)


#: How the word vocabulary's file cuts text in small letters.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Printable text below this needs no normalising but small letters, of which one has a letter that is two.
_PLAIN_BELOW = chr(0x250)
_TWO_LETTERS = chr(0x130)


def _plain(piece: str) -> bool:
    return piece.isprintable() and (
        piece.isascii() or max(piece) < _PLAIN_BELOW and _TWO_LETTERS not in piece
    )


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves,
    the others for letters from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _encode_words(tokenizer) -> Callable[[list[str]], list]:
    """Ids of pieces. The words of plain pieces go straight to the model; everything else, and what may
    hold a special token, goes the tokenizer's whole way."""
    model, letters = tokenizer.model, {b: c for c, b in byte_letters().items()}

    def encode(fresh: list[str]) -> list:
        seen: dict[str, list[int]] = {}
        out: list = []
        rest = []
        for at, piece in enumerate(fresh):
            if "<|" in piece or not _plain(piece):
                out.append([])
                rest.append(at)
                continue
            ids: list[int] = []
            for word in _WORDS.findall(piece.lower()):
                known = seen.get(word)
                if known is None:
                    shown = word if word.isascii() else word.encode().decode("latin-1").translate(letters)
                    known = seen[word] = [t.id for t in model.tokenize(shown)]
                ids += known
            out.append(ids)
        for i in range(0, len(rest), JOINED):
            some = rest[i : i + JOINED]
            coded = tokenizer.encode([fresh[j] for j in some], is_pretokenized=True, add_special_tokens=False)
            words = coded.word_ids
            if None in words:  # a special token, which belongs to no word
                for j in some:
                    out[j] = tokenizer.encode(fresh[j], add_special_tokens=False).ids
                continue
            for word, token in zip(words, coded.ids):
                out[some[word]].append(token)
        return out

    return encode


def word_cache(vocabulary: str) -> PieceCache:
    """Cache over a `tokenizers` file that drops white space, kept by the worker."""
    return keep(("words", vocabulary), lambda: _word_cache(vocabulary))


def _word_cache(vocabulary: str) -> PieceCache:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return PieceCache(pc.ascii_split_whitespace, _encode_words(tokenizer))


def token_slices(batches, vocabulary: str, end_id: int):
    """Over Arrow batches with doc_id and text: (doc_ids, flat ids, counts) for slices of documents,
    each document's ids followed by `end_id`."""
    cache = word_cache(vocabulary)
    for batch in batches:
        doc_ids, texts = batch.column("doc_id"), batch.column("text")
        for begin, end in slices(texts):
            flat, sizes = cache.ids(texts.slice(begin, end - begin))
            with_end = np.insert(flat, np.cumsum(sizes), end_id)
            del flat
            yield doc_ids.slice(begin, end - begin), with_end, sizes + 1
            pa.default_memory_pool().release_unused()  # else a worker keeps its largest slice's memory
