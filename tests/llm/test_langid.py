import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patronage.llm import langid
from patronage.llm.queries import op2


def plain_kneser_ney(words, alphabet, order):
    """Probability of the last symbol of an n-gram, straight from the definition."""
    grams = [Counter() for _ in range(order + 1)]
    for word, n in words.items():
        marked = chr(langid.BEGIN) + word + chr(langid.END)
        for end in range(2, len(marked) + 1):
            for size in range(1, min(order, end) + 1):
                grams[size][marked[end - size : end]] += n
    counts = [None, *({} for _ in range(order))]
    for size in range(1, order + 1):
        for g, n in grams[size].items():
            left = sum(1 for h in grams[size + 1] if h[1:] == g) if size < order else 0
            counts[size][g] = n if size == order or g[0] == chr(langid.BEGIN) or not left else left
    def discount(size):
        ones, twos = (sum(1 for n in counts[size].values() if n == k) for k in (1, 2))
        return ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(gram):
        if not gram:
            return 1 / alphabet
        size, context = len(gram), gram[:-1]
        after = {g: n for g, n in counts[size].items() if g[:-1] == context}
        if not after:
            return p(gram[1:])
        d, total = discount(size), sum(after.values())
        return max(after.get(gram, 0) - d, 0) / total + d * len(after) / total * p(gram[1:])

    return p


def test_scores_are_those_of_the_definition():
    words = {"banana": 3, "band": 1, "an": 2, "dab": 1, "nab": 1, "ba": 1}
    model, p = langid.CharModel.fit(words, 9), plain_kneser_ney(words, 9, langid.ORDER)
    scorer = langid.Scorer([model])
    for word in ["banana", "band", "zebra", "nanny", "a", "bandana"]:
        marked = chr(langid.BEGIN) + word + chr(langid.END)
        want = -sum(math.log(p(marked[max(0, i + 1 - langid.ORDER) : i + 1])) for i in range(1, len(marked)))
        nats, size = scorer.texts(pa.array([word.upper()]))[0]
        assert size == len(word) + 1 and nats == pytest.approx(want, rel=1e-9)
    seen = defaultdict(float)
    for c in [*"bandzqwy"[:7], chr(langid.END)]:
        seen["sum"] += p("ba" + c)
    assert seen["sum"] <= 1 + 1e-9


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = op2.query(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.count() == docs.count()
    held = found.where("held_out and lang is not null")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count() > 0
    assert found.where("score < 0 or score > 1").count() == 0
    assert found.where("accepted").count() >= 0.995 * found.count()


def test_prediction_looks_at_the_text_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "doc_id": F.col("doc_id") + 1000})
    a, b = (langid.predict(d, model).select("text", "lang_pred", "score").collect() for d in (docs, other))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_odd_documents(spark, sf_dir, odd_docs, clashing):
    model = langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    docs = clashing(odd_docs)
    out = langid.predict(docs, model)
    assert out.columns == [*(c for c in docs.columns if c not in ("score", "accepted")), "lang_pred", "score", "accepted"]
    for r in out.collect():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
        else:
            assert r["lang_pred"] in model.languages
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns


def test_foreign_texts_are_rejected(spark, sf_dir):
    model = langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = [("xkq zvw qqjx bnm wrt plkj hgf dsq zxcv " * 5,), ("Съешь же ещё этих мягких французских булок " * 3,)]
    assert langid.predict(spark.createDataFrame(rows, "text string"), model).where("accepted").count() == 0


def test_wrong_labels_move_no_threshold(spark, sf_dir):
    """Some documents labelled as another language: foreign texts still go, others stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wrong = (F.col("doc_id") % 97 == 0) & (F.col("lang") != "en")
    model = langid.fit(docs.withColumn("lang", F.when(wrong, "en").otherwise(F.col("lang"))))
    rows = [("xkq zvw qqjx bnm wrt plkj hgf dsq zxcv " * 5,), ("Съешь же ещё этих мягких французских булок " * 3,)]
    assert langid.predict(spark.createDataFrame(rows, "text string"), model).where("accepted").count() == 0
    assert langid.predict(docs, model).where("accepted").count() >= 0.99 * docs.count()


def test_without_labels(spark, odd_docs):
    for docs in (odd_docs.limit(0), odd_docs.withColumn("lang", F.lit(None).cast("string"))):
        out = langid.predict(docs, langid.fit(docs)).collect()
        assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in out)
        assert all(r["accepted"] == any(c.isalpha() for c in r["text"] or "") for r in out)


def test_samples_are_bounded_where_rows_repeat(spark):
    assert zlib.crc32(b"7") % 3 != 1
    rows = [(7, "aa bb", "en")] * 200 + [(i, f"w{i}", "fr") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["lang"]: r["count"] for r in langid._sample(docs, 30).groupBy("lang").count().collect()} == {
        "en": 30, "fr": 30,
    }


def test_mixed_rows_sum_by_text():
    rows = np.arange(12.0).reshape(6, 2)
    assert langid.sum_runs(rows, np.array([0, 2, 0, 4])).tolist() == [[0, 0], [2, 4], [0, 0], [28, 32]]


def test_sample_where_most_rows_cannot_be_learned_from(spark):
    """Rows without text, without doc_id, and that repeat one doc_id don't take the places of others."""
    learn = [(i, f"text {i}", "en") for i in range(300)]
    other = [(i, None, "en") for i in range(300, 9000)] + [(None, "x", "en")] * 2000 + [(5, "text 5", "en")] * 500
    docs = spark.createDataFrame(learn + other, "doc_id long, text string, lang string")
    can = docs.where(langid.learnable(docs)).select("doc_id").distinct().count()
    texts = [r["text"] for r in langid._sample(docs, 100).collect()]
    assert len(texts) == len(set(texts)) == min(100, can) == 100
