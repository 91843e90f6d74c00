"""Quality of documents by hierarchical empirical Bayes: the text's evidence and its site's record.

A logistic classifier over shape features of the whole text gives each document a probability. Sites
are hosts, and paths within hosts; grouped sums over all documents give each one's mean, and analysis of
variance says how far hosts differ from each other and paths from their host. A host's posterior mean
lies between its own mean and the global one, a path's between its own and its host's, the nearer to the
upper one the fewer documents it has. The path's posterior, without the document itself, takes the
place of the global prior in the document's odds.

The classifier is fitted on at most `FIT` labelled documents, chosen by a hash; everything else covers all
documents, whose texts are judged once. A document is accepted from the threshold on: one half, or less
where fewer labelled documents lie on the wrong side of a lower one.

Defined results: a null or empty text has the features of an empty one; documents without source stand
under the empty host, those without language under the empty path; with no labels, or of one kind only,
all have the score one half and are accepted; several labels of a document count by their mean, rounded; null
labels count as none; other columns pass through, the result's own replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.frames import aside, restored
from patronage.llm.langid import held_out
from patronage.llm.tokens import list_sizes, slices
from patronage.session import cut_lineage

FIT = 20_000
#: Steps of the probability at which a threshold may lie.
STEPS = 1000
#: Bytes of text whose features are computed at once.
SLICE = 2_000_000
RIDGE = 1.0
#: Logit of the classifier is held within this, so that a site's record keeps a say.
MOST_LOGIT = 12.0

FEATURES = [
    "log bytes", "letters", "capitals of letters", "digits", "marks", "mark runs", "blanks", "line breaks",
    "distinct words", "repeated neighbours", "bytes a word", "repeated lines", "words that are marks",
]


def _kinds() -> np.ndarray:
    """Kind of each byte: 0 small letter, 1 capital, 2 digit, 3 mark, 4 blank, 5 line break, 6 other."""
    kind = np.full(256, 3)
    kind[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 0
    kind[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
    kind[[ord(c) for c in "0123456789"]] = 2
    kind[:33] = 4
    kind[[10, 13]] = 5
    kind[128:] = 6
    return kind


_KIND = _kinds()


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    n = len(texts)
    size = np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), np.int64)
    raw = np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)
    kind = _KIND[raw]
    of_byte = np.repeat(np.arange(n), size)
    counts = np.bincount(of_byte * 7 + kind, minlength=7 * n).reshape(n, 7)
    same = np.flatnonzero((raw[1:] == raw[:-1]) & (kind[1:] == 3)) + 1
    runs = np.bincount(of_byte[same], minlength=n)
    words = pc.ascii_split_whitespace(texts)
    coded = words.flatten().dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False).astype(bool)[at]  # at the ends, blanks part nothing
    at, of = at[full], np.repeat(np.arange(n), list_sizes(words))[full]
    number = np.bincount(of, minlength=n)
    distinct = np.bincount(np.unique(of * (len(coded.dictionary) + 1) + at) // (len(coded.dictionary) + 1), minlength=n)
    again = np.zeros(len(at), bool)
    again[1:] = (at[1:] == at[:-1]) & (of[1:] == of[:-1])
    bare = pc.match_substring_regex(coded.dictionary, r"^[!-/:-@\[-`{-~]+$").to_numpy(zero_copy_only=False).astype(bool)
    lines = pc.split_pattern(texts, "\n")
    line = lines.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lines_of = np.repeat(np.arange(n), list_sizes(lines))
    top = int(line.max(initial=0)) + 1
    kinds_of_line = np.bincount(np.unique(lines_of * top + line) // top, minlength=n)
    small, capital, digit, mark, blank, breaks, other = counts.T
    letters, total, words_n = small + capital, np.maximum(size, 1), np.maximum(number, 1)
    return np.stack(
        [
            np.log1p(size), (letters + other) / total, capital / np.maximum(letters, 1), digit / total, mark / total,
            runs / total, blank / total, breaks / total, distinct / words_n,
            np.bincount(of[again], minlength=n) / words_n, size / words_n,
            1 - kinds_of_line / np.maximum(list_sizes(lines), 1),
            np.bincount(of[bare[at]] if len(at) else of, minlength=n) / words_n,
        ],
        axis=1,
    )


class Classifier:
    """Logistic regression on standardised features and their squares, fitted by Newton's method."""

    def __init__(self, rows: np.ndarray, good: np.ndarray):
        self.mean, self.scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-6)
        wide = self._wide(rows)
        weight, penalty = np.zeros(wide.shape[1]), np.full(wide.shape[1], RIDGE)
        penalty[0] = 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(wide @ weight, -30, 30)))
            slope = wide.T @ (good - p) - penalty * weight
            bend = (wide * (p * (1 - p))[:, None]).T @ wide + np.diag(penalty + 1e-9)
            step = np.linalg.solve(bend, slope)
            weight = weight + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
            if np.abs(step).max() < 1e-6:
                break
        self.weight = weight

    def _wide(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(z), 1)), z, z * z / 4], axis=1)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self._wide(rows) @ self.weight, -MOST_LOGIT, MOST_LOGIT)


def host_of(source: Column) -> Column:
    """The host of a url, or all of what has no scheme."""
    return F.coalesce(F.regexp_extract(source, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1), F.lit(""))


def path_of() -> Column:
    """The first step of a url's path; a source that has none is divided by its documents' language."""
    step = F.regexp_extract("source", r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*/([^/?#]*)", 1)
    return F.when(F.coalesce(step, F.lit("")) != "", step).otherwise(F.coalesce("lang", F.lit("")))


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT) -> Classifier | None:
    """The classifier, or None where the labels don't have both kinds."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id").cast("long"))).groupBy(F.col("doc_id").cast("long").alias("_label_of"))
    known = known.agg(F.round(F.avg("quality")).cast("int").alias("_good"))
    some = cut_lineage(known.orderBy(F.xxhash64("_label_of"), "_label_of").limit(most))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    texts = texts.join(some, F.col("_doc") == F.col("_label_of"))
    # of rows that repeat a labelled doc_id one is learned from
    texts = texts.groupBy("_doc", "_good").agg(F.min("text").alias("text")).select("_good", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text"), SLICE):
                part = batch.slice(begin, end - begin)
                rows = pa.array(list(features(part.column("text"))), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("_good"), rows], ["good", "row"])

    rows = texts.mapInArrow(run, "good int, row array<double>").toArrow()  # `most` at most
    good = rows["good"].to_numpy().astype(float)
    if len(set(good.tolist())) < 2:
        return None
    return Classifier(np.array(rows["row"].to_pylist()), good)


def _with_logit(docs: DataFrame, model: Classifier | None, name: str) -> DataFrame:
    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text"), SLICE):
                part = batch.slice(begin, end - begin)
                logits = model.logits(features(part.column("text")))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(logits)], [*part.schema.names, name])

    return docs.withColumn(name, F.lit(0.0)) if model is None else docs.mapInArrow(run, schema)


def _strength(within: float, between: float) -> float:
    """How many documents the upper level's mean is worth."""
    return float(np.clip(within / max(between, 1e-9), 1.0, 1e6))


def _levels(sites: DataFrame) -> tuple[float, float, float]:
    """(global mean, strength of the global mean for hosts, of a host's for its paths) by analysis of
    variance over the sums of the paths."""
    hosts = sites.groupBy("_host").agg(
        F.sum("_n").alias("n"), F.sum("_sum").alias("s"), F.sum("_squares").alias("q"), F.count("*").alias("paths"),
        F.sum(F.col("_sum") * F.col("_sum") / F.col("_n")).alias("between"),
        F.sum(F.col("_n") * F.col("_n")).alias("nn"),
    )
    r = hosts.agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("paths").alias("paths"),
        F.count("*").alias("hosts"), F.sum("between").alias("paths_fit"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("hosts_fit"),
        F.sum(F.col("n") * F.col("n")).alias("host_nn"), F.sum(F.col("nn") / F.col("n")).alias("path_nn"),
    ).first()
    if not r["n"]:
        return 0.5, 1.0, 1.0
    n, mean = float(r["n"]), r["s"] / r["n"]
    within = (r["q"] - r["paths_fit"]) / max(n - r["paths"], 1.0)
    paths = (r["paths_fit"] - r["hosts_fit"]) / max(r["paths"] - r["hosts"], 1)
    paths = (paths - within) * max(r["paths"] - r["hosts"], 1) / max(n - r["path_nn"], 1.0)
    hosts_part = (r["hosts_fit"] - n * mean * mean) / max(r["hosts"] - 1, 1)
    hosts_part = (hosts_part - within) * max(r["hosts"] - 1, 1) / max(n - r["host_nn"] / n, 1.0)
    return float(mean), _strength(within, hosts_part), _strength(within, paths)


def _logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


def _probability(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def score(docs: DataFrame, labels: DataFrame, names: tuple[str, ...] = ("quality", "text_score", "site", "accepted")):
    """The documents with posterior probability, the text's own, the site's posterior, and acceptance."""
    quality, own, site, accepted = names
    given = docs.drop(*names)
    docs = aside(given, "doc_id", "text", "source", "lang")
    model = fit(docs, labels)
    rows = docs.withColumns({"_host": host_of(F.col("source")), "_path": path_of()})
    judged = cut_lineage(_with_logit(rows, model, "_logit"))  # with the texts, which are judged once
    p = _probability(F.col("_logit"))
    sites = cut_lineage(
        judged.groupBy("_host", "_path").agg(F.count("*").alias("_n"), F.sum(p).alias("_sum"), F.sum(p * p).alias("_squares"))
    )
    mean, for_hosts, for_paths = _levels(sites)
    hosts = sites.groupBy(F.col("_host").alias("_of")).agg(F.sum("_n").alias("_host_n"), F.sum("_sum").alias("_host_sum"))
    both = sites.join(hosts, F.col("_host") == F.col("_of")).select(
        F.col("_host").alias("_h"), F.col("_path").alias("_p"), "_n", "_sum", "_host_n", "_host_sum"
    )
    both = cut_lineage(both)

    def posterior(rows: DataFrame) -> DataFrame:
        """Joins each document's sites and leaves the document itself out of their record."""
        p = _probability(F.col("_logit"))
        joined = rows.join(both, (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")))
        host = (F.lit(for_hosts * mean) + F.col("_host_sum") - p) / (F.lit(for_hosts) + F.col("_host_n") - 1)
        joined = joined.withColumn(own, p).withColumn("_host_mean", host)
        path = (F.lit(for_paths) * F.col("_host_mean") + F.col("_sum") - p) / (F.lit(for_paths) + F.col("_n") - 1)
        joined = joined.withColumn(site, path)
        return joined.withColumn(quality, _probability(F.col("_logit") + _logit(F.col(site)) - _logit(F.lit(mean))))

    found = posterior(judged)
    threshold = _threshold(found, labels, quality) if model else 0.0
    return restored(found.withColumn(accepted, F.col(quality) >= threshold), given, *names)


def _threshold(found: DataFrame, labels: DataFrame, quality: str) -> float:
    """The threshold of at most one half with the fewest labelled documents on its wrong side, the highest
    of equals. A wrong label far from it adds one to all that come into question."""
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id").cast("long")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_of")).agg(F.round(F.avg("quality")).alias("_good"))
    judged = found.select(F.col("doc_id").cast("long").alias("_doc"), F.floor(F.col(quality) * STEPS).alias("step"))
    counted = judged.join(known, F.col("_doc") == F.col("_of")).groupBy("step")
    good, bad = np.zeros(STEPS + 1), np.zeros(STEPS + 1)
    for r in counted.agg(F.sum("_good").alias("good"), F.count("*").alias("n")).collect():  # a row a step
        good[r["step"]], bad[r["step"]] = r["good"], r["n"] - r["good"]
    wrong = np.cumsum(good) - good + bad.sum() - (np.cumsum(bad) - bad)  # at a threshold of step / STEPS
    half = wrong[: STEPS // 2 + 1]
    least = np.flatnonzero(half == half.min())
    return float(least[-1] / STEPS) if good.sum() and bad.sum() else 0.5


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't rejected, with their own columns."""
    given = aside(docs, "doc_id", "text", "source", "lang")
    return restored(score(given, labels).where("accepted"), docs)
