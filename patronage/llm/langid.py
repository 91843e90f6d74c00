"""Language of whole texts by character models with interpolated Kneser-Ney smoothing.

Every language has a model of its words' letters, each given up to `ORDER` - 1 symbols before it in
the word, the word's begin and end among them. Its n-grams lie in sorted arrays of 64-bit hashes, with
the smoothed log probability of each, and of each context the weight of what backs off from it. A text
gets the language with the lowest cross-entropy per symbol.

The models are fitted on at most `FIT` labelled documents a language, and calibrated on at most
`CALIBRATE` others, both in the order of a hash: whole documents, bounded in number. Calibration
chooses the scale that turns cross-entropies into a probability (the score), and when a text of n
symbols is rejected: if its cross-entropy is further from its language's mean, in deviations of texts
of that length, than `REACH` times any labelled document's of the calibration, and if also it is what
labelled documents have under the best wrong model (all but the lowest `FOREIGN` of them).

Words are scored once for each distinct piece of text between white space in a task.

Defined results: a null text, and one without letters, is `und` with score 0 and not accepted; if no
document is labelled, all are `und`, and those with letters are accepted; ties go to the first language
in alphabetical order; null doc_ids are neither learned from nor held out; other columns pass through,
and the result's own columns replace those of the same name.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.frames import aside, restored
from patronage.llm.tokens import PieceIndex, slices
from patronage.llm.worker import keep
from patronage.session import cut_lineage

ORDER = 5
FIT = 1000
CALIBRATE = 500
#: Share of a language's calibration that is set aside, the documents that fit worst: a few wrong labels.
ASIDE = 0.02
#: A text is rejected beyond so many times the largest deviation of the calibration's other documents.
REACH = 1.5
#: ... and never within so many deviations, since few documents show few of the odd ones.
LEAST_REACH = 16.0
FOREIGN = 0.05
UNKNOWN = "und"
BEGIN, END = 2, 3
#: Bytes of pieces and their scores that a worker keeps.
MOST_BYTES = 40_000_000
#: Bytes of text that are scored at once.
SLICE = 4_000_000

_LETTERS = regex.compile(r"\p{L}+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(piece: str) -> list[str]:
    return _LETTERS.findall(piece.lower())


# -- fitting


def _hash(symbols: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of symbols; rows of other lengths hash apart."""
    out = np.full(len(symbols), symbols.shape[1] + 1, np.uint64)
    for column in symbols.T:
        out = (out ^ column.astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _sorted(table: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order, and their values."""
    by_size = defaultdict(list)
    for gram in table:
        by_size[len(gram)].append(gram)
    keys, values = [np.zeros(0, np.uint64)], [np.zeros(0)]
    for size, grams in by_size.items():
        flat = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32)
        keys.append(_hash(flat.reshape(-1, size) if size else np.zeros((len(grams), 0), np.uint32)))
        values.append(np.array([table[g] for g in grams]))
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    return key[order], value[order]


@dataclass
class CharModel:
    """Sorted hashes of n-grams with their log probability, and of contexts with their back-off's."""

    grams: np.ndarray
    gram_logs: np.ndarray
    contexts: np.ndarray
    context_logs: np.ndarray
    unseen: float

    @classmethod
    def fit(cls, words: dict[str, int], alphabet: int, order: int = ORDER) -> CharModel:
        """From words and their counts. The highest order counts n-grams; lower ones count in how many
        different contexts an n-gram stands, except where it begins a word and has only that one."""
        counts: list[dict[str, int]] = [defaultdict(int) for _ in range(order + 1)]
        for word, n in words.items():
            marked = chr(BEGIN) + word + chr(END)
            for end in range(2, len(marked) + 1):
                for size in range(1, min(order, end) + 1):
                    counts[size][marked[end - size : end]] += n
        used = [None] * (order + 1)
        for size in range(1, order + 1):
            if size == order:
                used[size] = counts[size]
                continue
            wider: dict[str, int] = defaultdict(int)
            for gram in counts[size + 1]:
                wider[gram[1:]] += 1
            used[size] = {g: n if g[0] == chr(BEGIN) else wider.get(g, n) for g, n in counts[size].items()}
        logs: dict[str, float] = {}
        weights: dict[str, float] = {}
        lower = {"": 1.0 / alphabet}
        for size in range(1, order + 1):
            ones = sum(1 for n in used[size].values() if n == 1)
            twos = sum(1 for n in used[size].values() if n == 2)
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total: dict[str, int] = defaultdict(int)
            kinds: dict[str, int] = defaultdict(int)
            for gram, n in used[size].items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            here = {}
            for gram, n in used[size].items():
                context = gram[:-1]
                weight = discount * kinds[context] / total[context]
                here[gram] = max(n - discount, 0) / total[context] + weight * lower[gram[1:]]
            for context, n in total.items():
                weights[context] = float(np.log(discount * kinds[context] / n))
            logs |= {g: float(np.log(p)) for g, p in here.items()}
            lower = here
        return cls(*_sorted(logs), *_sorted(weights), float(np.log(1.0 / alphabet)))

    def score(self, symbols: np.ndarray, place: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each symbol; `place` is its position in its word, 0 for the begin mark."""
        out = np.zeros(len(symbols))
        open_at = np.flatnonzero(place > 0)
        for size in range(order, -1, -1):
            fits = open_at if size <= 1 else open_at[place[open_at] >= size - 1]
            if size == 0:
                out[fits] += self.unseen
                break
            rows = np.stack([symbols[fits - k] for k in range(size - 1, -1, -1)], axis=1)
            logs, seen = _find(self.grams, self.gram_logs, _hash(rows))
            out[fits[seen]] += logs[seen]
            missed = fits[~seen]
            back, known = _find(self.contexts, self.context_logs, _hash(rows[~seen, :-1]))
            out[missed[known]] += back[known]
            done = np.zeros(len(symbols), bool)
            done[fits[seen]] = True
            open_at = open_at[~done[open_at]]
            if not len(open_at):
                break
        return out


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[at], keys[at] == wanted


# -- scoring


class Scorer:
    """Scores of pieces by all models, each distinct piece once."""

    def __init__(self, models: list[CharModel]):
        self._models = models
        self._index = PieceIndex(pc.ascii_split_whitespace, self._learn, self._forget, lambda: self._sums.nbytes, MOST_BYTES)

    def _forget(self) -> None:
        self._sums = np.zeros((0, len(self._models) + 1))

    def _learn(self, fresh: list[str]) -> None:
        parted = [words_of(p) for p in fresh]
        flat = [w for ws in parted for w in ws]
        # each word as begin mark, letters, end mark
        marked = "".join(f"{chr(BEGIN)}{w}{chr(END)}" for w in flat)
        symbols = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.flatnonzero(symbols == BEGIN)
        sizes = np.diff(np.append(begins, len(symbols)))
        place = np.arange(len(symbols)) - np.repeat(begins, sizes)
        of_piece = np.repeat(np.repeat(np.arange(len(fresh)), [len(ws) for ws in parted]), sizes)
        table = np.zeros((len(fresh), len(self._models) + 1))
        table[:, -1] = np.bincount(of_piece[place > 0], minlength=len(fresh))
        for i, model in enumerate(self._models):
            table[:, i] = -np.bincount(of_piece, weights=model.score(symbols, place), minlength=len(fresh))
        self._sums = np.concatenate([self._sums, table])

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rows for all pieces (a column of nats for each model, then symbols), and the pieces of each text."""
        at, sizes = self._index.numbers(texts)
        return self._sums[at], sizes

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Sums over the pieces of each text."""
        rows, sizes = self.pieces(texts)
        return sum_runs(rows, sizes)


def sum_runs(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sizes), rows.shape[1]))
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = np.add.reduceat(rows, (np.cumsum(sizes) - sizes)[some], axis=0)
    return out


@dataclass
class LanguageModel:
    """Models by language, the scale of the score, and each language's usual cross-entropy."""

    languages: list[str]
    models: list[CharModel]
    scale: float = 1.0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None  # between texts
    noise: np.ndarray | None = None  # of one symbol
    reach: float = np.inf  # deviations that are accepted
    foreign: float = -np.inf  # cross-entropy of texts in another language

    def deviations(self, entropy: np.ndarray, of: np.ndarray, size: np.ndarray) -> np.ndarray:
        usual = np.sqrt(self.spread[of] ** 2 + self.noise[of] ** 2 / np.maximum(size, 1))
        return (entropy - self.mean[of]) / np.maximum(usual, 1e-3)

    def judge(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language's number or -1, score, accepted) of texts by their sums."""
        size = sums[:, -1]
        if not self.languages:
            return np.full(len(size), -1), np.zeros(len(size)), size > 0
        entropy = sums[:, :-1] / np.maximum(size, 1)[:, None]
        best = entropy.argmin(axis=1)
        least = entropy.min(axis=1)
        score = 1 / np.exp(-self.scale * (entropy - least[:, None])).sum(axis=1)
        near = self.deviations(least, best, size) <= self.reach
        near |= least <= self.foreign + 3 * self.noise[best] / np.sqrt(np.maximum(size, 1))
        return np.where(size > 0, best, -1), np.where(size > 0, score, 0.0), (size > 0) & near


def learnable(docs: DataFrame) -> Column:
    return (F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, count) over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], int] = defaultdict(int)
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text")
            for lang in set(langs):
                own = pc.ascii_split_whitespace(texts.filter(pa.array([x == lang for x in langs])))
                for row in own.flatten().value_counts().to_pylist():
                    for word in words_of(row["values"]):
                        found[lang, word] += row["counts"]
        rows = list(found.items())
        for i in range(0, len(rows), 50_000):
            part = rows[i : i + 50_000]
            columns = [[k[0] for k, _ in part], [k[1] for k, _ in part], [n for _, n in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "word", "count"])

    words = docs.select("lang", "text").mapInArrow(run, "lang string, word string, count long")
    return words.groupBy("lang", "word").agg(F.sum("count").alias("count"))


def _sample(docs: DataFrame, most: int) -> DataFrame:
    """(lang, text, turn) of at most `most` documents of each language, the first ones in the order of a
    hash; rows that repeat a doc_id come after all others. The share of the hash's range that holds about one and a half
    times as many is known from the languages' counts of such documents, so other texts go nowhere; the
    limit then holds for what is left. A language whose share holds too few is read in whole."""
    some = docs.where(learnable(docs)).withColumn("_h", F.xxhash64(F.col("doc_id").cast("long")))
    counts = some.groupBy(F.col("lang").alias("_lang")).agg(F.approx_count_distinct("_h").alias("_n"))
    counts = cut_lineage(counts)  # written, so that Spark knows that a row a language can be broadcast
    share = F.shiftrightunsigned("_h", 1) / float(2**63)
    own = Window.partitionBy("lang", "_h").orderBy("text")
    order = Window.partitionBy("lang").orderBy("_again", "_h", "text")

    def first(counts: DataFrame) -> DataFrame:
        near = some.join(counts, (F.col("lang") == F.col("_lang")) & (share * F.col("_n") <= 1.5 * most))
        near = near.select("lang", "text", "_h").withColumn("_again", F.row_number().over(own)).where(F.col("_again") <= most)
        near = near.withColumn("turn", F.row_number().over(order))
        return cut_lineage(near.where(F.col("turn") <= most).select("lang", "text", "turn", "_again"))

    found = first(counts)
    held = found.where(F.col("_again") == 1).groupBy(F.col("lang").alias("_held")).agg(F.count("*").alias("_m"))
    short = counts.join(held, F.col("_lang") == F.col("_held"), "left")
    short = short.where((F.coalesce("_m", F.lit(0)) < most) & (F.col("_n") > 1.5 * most)).select("_lang", "_n")
    short = cut_lineage(short.withColumn("_n", F.lit(0)))
    if not short.head(1):
        return found.drop("_again")
    whole = first(short)
    return found.join(short, F.col("lang") == F.col("_lang"), "left_anti").unionByName(whole).drop("_again")


def fit(docs: DataFrame, most_fit: int = FIT, most_calibrate: int = CALIBRATE) -> LanguageModel:
    """Models of the labelled languages of the documents that may be learned from."""
    named = _sample(docs, most_fit + most_calibrate)
    words: dict[str, dict[str, int]] = defaultdict(dict)
    counted = _word_counts(named.where(F.col("turn") <= most_fit)).toArrow().to_pylist()
    for row in counted:
        words[row["lang"]][row["word"]] = row["count"]
    languages = sorted(words)
    alphabet = len({c for of in words.values() for w in of for c in w}) + 2
    model = LanguageModel(languages, [CharModel.fit(words[x], alphabet) for x in languages])
    if languages:
        _calibrate(model, named, most_fit)
    return model


def _calibrate(model: LanguageModel, named: DataFrame, most_fit: int) -> None:
    shared = named.sparkSession.sparkContext.broadcast(pickle.dumps(model.models))
    n, languages = len(model.languages), model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pickle.loads(shared.value))
        for batch in batches:
            own = np.array([languages.index(x) if x in languages else -1 for x in batch.column("lang").to_pylist()])
            rows, sizes = scorer.pieces(batch.column("text"))
            nats, size = rows[np.arange(len(rows)), np.repeat(own, sizes)], rows[:, -1]
            squares = np.stack([nats * nats, nats * size, size * size], axis=1)
            out = np.concatenate([sum_runs(rows, sizes), sum_runs(squares, sizes)], axis=1)
            keep = (own >= 0) & (out[:, n] > 0)
            lists = pa.array(list(out[keep]), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(own[keep]), lists], ["own", "sums"])

    # the samples of languages with few documents serve for both
    wanted = Window.partitionBy("lang")
    sample = named.withColumn("held", F.max("turn").over(wanted))
    sample = sample.where((F.col("turn") > most_fit) | (F.col("held") <= most_fit)).select("lang", "text")
    rows = sample.mapInArrow(run, "own long, sums array<double>").toArrow()
    own = rows["own"].to_numpy()
    sums = np.array(rows["sums"].to_pylist()).reshape(len(own), n + 4)
    entropy = sums[:, :n] / np.maximum(sums[:, n], 1)[:, None]
    at = entropy[np.arange(len(own)), own]

    def loss(scale: float) -> float:
        return float(np.log(np.exp(-scale * (entropy - at[:, None])).sum(axis=1)).mean())

    if len(own):
        model.scale = min(np.geomspace(0.25, 64, 33), key=loss)
    model.reach = LEAST_REACH if len(own) else np.inf
    if len(own) and n > 1:
        wrong = entropy.copy()
        wrong[np.arange(len(own)), own] = np.inf
        model.foreign = float(np.quantile(wrong.min(axis=1), FOREIGN))
    model.mean, model.spread, model.noise = (np.zeros(n) for _ in range(3))
    for i in range(n):
        mine = sums[own == i]
        if not len(mine):
            continue
        mine = mine[np.argsort(mine[:, i] / mine[:, n], kind="stable")[: len(mine) - int(ASIDE * len(mine))]]
        size, (a, b, c) = mine[:, n].sum(), mine[:, n + 1 :].sum(axis=0)
        mean = float(mine[:, i].sum() / size)
        noise = max(a - 2 * mean * b + mean * mean * c, 0.0) / size
        each = mine[:, i] / mine[:, n]
        model.mean[i], model.noise[i] = mean, np.sqrt(noise)
        # what texts differ by beyond the noise of their symbols
        model.spread[i] = np.sqrt(max(float(((each - mean) ** 2 - noise / mine[:, n]).mean()), 0.0))
        model.reach = max(model.reach, REACH * float(model.deviations(each, np.full(len(mine), i), mine[:, n]).max()))


def _scorer(pickled: bytes) -> tuple[LanguageModel, Scorer]:
    def make() -> tuple[LanguageModel, Scorer]:
        model = pickle.loads(pickled)
        return model, Scorer(model.models)

    return keep(("languages", pickled), make)


def predict(
    docs: DataFrame, model: LanguageModel, names: tuple[str, str, str] = ("lang_pred", "score", "accepted")
) -> DataFrame:
    """The documents with language, score and acceptance; only `text` is looked at."""
    own = list(zip(names, (T.StringType(), T.DoubleType(), T.BooleanType())))
    kept = [f for f in docs.schema if f.name not in names]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in own)])
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # bounded by the fitted sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, scorer = _scorer(shared.value)
        said = pa.array([*model.languages, UNKNOWN])
        for batch in batches:
            for begin, end in slices(batch.column("text"), SLICE):
                part = batch.slice(begin, end - begin)
                best, score, accepted = model.judge(scorer.texts(part.column("text")))
                of = said.take(pa.array(np.where(best < 0, len(model.languages), best)))
                columns = [*part.columns, of, pa.array(score), pa.array(accepted)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *names])

    return docs.select([f.name for f in kept]).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that aren't rejected, with their own columns, by models fitted on them."""
    named = aside(docs, "text")
    return restored(predict(named, fit(docs)).where("accepted"), docs)
