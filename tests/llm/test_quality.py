import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patronage.llm import quality
from patronage.llm.queries import op3

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    found = op3.query(spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    held = found.join(labels, "doc_id").where("held_out and label is not null")
    assert held.where("(quality >= 0.5) = (label = 1)").count() >= 0.95 * held.count() > 0
    assert held.where("label = 1 and not accepted").count() <= 0.02 * held.count()


def test_posteriors_against_plain_sums(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(quality, "_levels", lambda sites: (0.7, 5.0, 3.0))
    found = op3.query(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang"), "doc_id"
    )
    rows = found.collect()
    logit = lambda p: np.log(p / (1 - p))
    for r in rows[:60]:
        host = [x["text_score"] for x in rows if x["source"] == r["source"] and x["doc_id"] != r["doc_id"]]
        path = [
            x["text_score"] for x in rows
            if (x["source"], x["lang"]) == (r["source"], r["lang"]) and x["doc_id"] != r["doc_id"]
        ]
        mean = (5 * 0.7 + sum(host)) / (5 + len(host))
        site = (3 * mean + sum(path)) / (3 + len(path))
        assert r["site"] == pytest.approx(site, abs=1e-9)
        want = 1 / (1 + np.exp(-(logit(r["text_score"]) + logit(site) - logit(0.7))))
        assert r["quality"] == pytest.approx(want, abs=1e-6)


def test_sparse_sites_shrink_and_large_ones_speak(spark):
    """Hosts that differ: the estimate of their strength lets a large bad host be seen as bad."""
    rng = np.random.default_rng(0)
    sites = []
    for host in range(40):
        rate = rng.beta(2, 2)
        for path in range(3):
            p = np.clip(rng.normal(rate, 0.1, 50), 0, 1)
            sites.append((f"h{host}", str(path), 50, float(p.sum()), float((p * p).sum())))
    df = spark.createDataFrame(sites, "_host string, _path string, _n long, _sum double, _squares double")
    mean, hosts, paths = quality._levels(df)
    assert mean == pytest.approx(0.5, abs=0.1)
    assert hosts < 5 < paths  # hosts differ by far more than their documents do, paths don't differ


def test_hosts_and_paths(spark):
    rows = [("https://a.b/en/x?q", "de"), ("src0", "fr"), (None, None), ("http://h?x", None), ("a.b/c", "en"), ("", "en")]
    df = spark.createDataFrame(rows, "source string, lang string")
    out = df.select(quality.host_of(F.col("source")).alias("h"), quality.path_of().alias("p")).collect()
    assert [tuple(r) for r in out] == [("a.b", "en"), ("src0", "fr"), ("", ""), ("h", ""), ("a.b", "c"), ("", "en")]


def test_odd_documents(spark, sf_dir, odd_docs, clashing):
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, None), (10, 1, 0), (10, 1, 0), (None, 1, 0), (2, None, 1)], LABELS)
    docs = clashing(odd_docs)
    out = quality.score(docs, labels)
    names = ["quality", "text_score", "site", "accepted"]
    assert out.columns == [*(c for c in docs.columns if c not in names), *names]
    assert out.count() == docs.count() and out.where("quality is null or quality < 0 or quality > 1").count() == 0
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns


def test_without_labels(spark, odd_docs):
    for labels in ([], [(7, 1, 0)], [(7, None, 0)]):
        out = quality.score(odd_docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(out) == odd_docs.count() and all(r["accepted"] and r["quality"] == 0.5 for r in out)
    assert quality.score(odd_docs.limit(0), spark.createDataFrame([(7, 1, 0)], LABELS)).count() == 0


def test_features():
    rows = quality.features(pa.array(["AAA bb bb\nbb bb", None, "", "a1!! ##\na1!! ##"]))
    named = [dict(zip(quality.FEATURES, r)) for r in rows]
    assert named[0]["capitals of letters"] == 3 / 11 and named[0]["repeated neighbours"] == 3 / 5
    assert not rows[1].any() and not rows[2].any()
    assert named[3]["words that are marks"] == 0.5 and named[3]["repeated lines"] == 0.5
    assert named[3]["mark runs"] == 4 / 15


def _judged(spark, scores):
    """Documents with a quality and a label each, (quality, label), and the labels."""
    rows = [(i, float(q)) for i, (q, _) in enumerate(scores)]
    labels = [(i, label, 0) for i, (_, label) in enumerate(scores)]
    return spark.createDataFrame(rows, "doc_id long, quality double"), spark.createDataFrame(labels, LABELS)


def test_wrong_labels_hardly_move_the_threshold(spark):
    rng = np.random.default_rng(1)
    scores = [(q, 1) for q in rng.uniform(0.6, 1, 3000)] + [(q, 0) for q in rng.uniform(0, 0.2, 3000)]
    assert quality._threshold(*_judged(spark, scores), "quality") == 0.5
    flipped = scores + [(0.01, 1)] * 40 + [(0.99, 0)] * 40
    assert quality._threshold(*_judged(spark, flipped), "quality") == 0.5
    # good documents below one half, more than there are bad ones, lower it
    low = [(q, 1) for q in rng.uniform(0.35, 1, 3000)] + [(q, 0) for q in rng.uniform(0, 0.3, 3000)]
    assert 0.3 <= quality._threshold(*_judged(spark, low), "quality") <= 0.37
    assert quality._threshold(*_judged(spark, [(0.2, 1)] * 9), "quality") == 0.5


def test_repeated_rows_of_a_labelled_document_are_learned_once(spark, monkeypatch):
    seen, plain = [], quality.Classifier.__init__

    def counted(self, rows, good):
        seen.append(len(rows))
        plain(self, rows, good)

    monkeypatch.setattr(quality.Classifier, "__init__", counted)
    docs = [(i, f"some words of text {i}", "en", "h") for i in range(30)] + [(3, "again", "en", "h")] * 200
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], LABELS)
    quality.score(df, labels).count()
    assert len(seen) == 1 and seen[0] <= 30
