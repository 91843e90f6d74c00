import brute
import corpus_pipeline
import pytest
from test_packing import check

from patronage.llm import langid, quality
from patronage.session import cut_lineage


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage was given and what it returned."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        made = cut_lineage(stage(spark, docs, sf_dir))
        out.append((name, docs, made))
        docs = made
    return out


def test_stages(spark, sf_dir, stages):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    for name, given, made in stages[:-1]:
        assert made.columns == columns, name
        assert made.exceptAll(given).count() == 0, name
    assert [s[0] for s in stages] == ["language_id", "quality_classifier", "near_dedup", "best_fit_packing"]


def test_filters_keep_what_their_operators_accept(spark, sf_dir, stages):
    _, given, made = stages[0]
    want = langid.predict(given, langid.fit(given)).where("accepted").select("doc_id").collect()
    assert sorted(made.select("doc_id").collect()) == sorted(want)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    _, given, made = stages[1]
    want = quality.score(given, labels).where("accepted").select("doc_id").collect()
    assert sorted(made.select("doc_id").collect()) == sorted(want)
    bad = labels.where("quality = 0").join(given, "doc_id").count()
    assert made.join(labels.where("quality = 0"), "doc_id").count() <= 0.05 * bad
    good = given.join(labels.where("quality = 1"), "doc_id").count()
    assert made.join(labels.where("quality = 1"), "doc_id").count() >= 0.99 * good > 0


def test_near_dedup_against_all_pairs(stages):
    _, given, made = stages[2]
    fps = {r["doc_id"]: brute.simhash(r["text"]) for r in given.select("doc_id", "text").collect()}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    group = brute.groups(fps, pairs)
    assert sorted(r["doc_id"] for r in made.select("doc_id").collect()) == sorted(set(group.values()))


def test_packing_of_what_is_left(stages, vocabularies):
    _, given, made = stages[3]
    docs = [tuple(r) for r in given.select("doc_id", "text").collect()]
    check(made.collect(), docs, vocabularies["word"], 2048)


def test_run_gives_the_stages_rows(spark, sf_dir, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).select(columns).collect()) == sorted(
        stages[-1][2].select(columns).collect()
    )
