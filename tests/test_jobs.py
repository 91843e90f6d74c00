"""Sources, stored tables and the jobs from staging to briefs."""

import dataclasses
import datetime as dt
import json
import math
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.operators.affinity import load_affinity
from patronage.plans import association, briefs, explain, features, segments
from patronage.schemas import FEATURES, KEYS, SCHEMAS, conform, empty
from patronage.sources import star
from patronage.sources.delimited import MISSING, detect_charsets, read_text_csv, typed
from patronage.sources.tables import Tables

EARLY, LATE = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)


def test_scratch_is_shared_and_released(spark, monkeypatch):
    from patronage import session

    shared = session.shared_dir(spark)
    assert session.shared_dir(spark) == shared
    monkeypatch.setattr(session, "_scratch", [])
    kept = session.cut_lineage(spark.range(10))
    assert kept.count() == 10 and session._scratch[0].startswith(shared)
    assert session.release(spark) == 1 and session._scratch == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FAILED_READ_FILE"):
        kept.count()


def test_missing_words_are_those_of_pandas():
    from pandas._libs.parsers import STR_NA_VALUES

    assert set(MISSING) == set(STR_NA_VALUES)


@pytest.mark.parametrize(("encoding", "charset"), [("utf-8", "UTF-8"), ("utf-8-sig", "UTF-8"), ("cp949", "x-windows-949"), ("euc-kr", "x-windows-949")])
def test_csv_charsets(spark, tmp_path, encoding, charset):
    path = tmp_path / "in.csv"
    text = '이름,값,메모\n' + "a,1,x\n" * 2000 + '가게,NA,"말, ""큰"" 따옴표"\n나,,n/a\n'
    path.write_bytes(text.encode(encoding))
    assert list(detect_charsets(spark, str(path)).values()) == [charset]
    got = read_text_csv(spark, str(path))
    want = pd.read_csv(path, encoding=encoding, dtype=str)
    assert got.columns == list(want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        repr(tuple(None if v != v else v for v in r)) for r in want.itertuples(index=False, name=None)
    )


def test_folder_of_several_charsets(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('이름,메모\n가게,"두\n줄"\n'.encode("utf-8"))
    (tmp_path / "b.csv").write_bytes('이름,메모\n나,다\n'.encode("cp949"))
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    got = read_text_csv(spark, str(tmp_path), multiline=True)
    assert sorted(map(tuple, got.collect())) == [("가게", "두\n줄"), ("나", "다")]
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before


def test_dates(spark):
    texts = {
        "2022-10-24": "2022-10-24", "20221024": "2022-10-24", "2022/1/4": "2022-01-04", "2022.10.24": "2022-10-24",
        "22^10^24": "2022-10-24", "991024": "1999-10-24", "700101": "1970-01-01", "2022-10-24 10:30:00": "2022-10-24",
        "2022-13-01": None, "20220230": None, "2022": None, "x": None, "": None, "2022-10": None, "20221024x": None,
    }
    df = spark.createDataFrame([(k,) for k in texts], "day string")
    got = typed(df, T.StructType.fromDDL("day date")).select(F.date_format("day", "yyyy-MM-dd")).collect()
    assert [r[0] for r in got] == list(texts.values())


def test_unreadable_csv(spark, tmp_path):
    (tmp_path / "bad.csv").write_bytes(b"a,b\n\xff\xff,1\n")
    with pytest.raises(ValueError):
        detect_charsets(spark, str(tmp_path / "bad.csv"))


def test_declared_tables(spark):
    assert set(KEYS) == set(SCHEMAS)
    for table, keys in KEYS.items():
        made = empty(spark, table)
        assert made.schema == SCHEMAS[table] and made.count() == 0 and set(keys) <= set(made.columns)


def test_tables_keep_the_last_complete_run(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.recreate("fx_age_bucket")
    assert tables.read("fx_age_bucket").count() == 0
    first = spark.createDataFrame([("m", "202401", "10s")], SCHEMAS["fx_age_bucket"])
    tables.upsert("fx_age_bucket", first, ["ym"])
    tables.upsert("fx_age_bucket", first.withColumn("age_bucket", F.lit("30s")), ["ym"])
    assert tables.read("fx_age_bucket").collect() == [("m", "202401", "30s")]
    few = Tables(spark, str(tmp_path / "few"), keep_runs=2)
    for bucket in ("10s", "30s", "40s"):
        few.upsert("fx_age_bucket", first.withColumn("age_bucket", F.lit(bucket)), ["ym"])
    assert few.read("fx_age_bucket").first()["age_bucket"] == "40s"
    assert len(list((tmp_path / "few" / "fx_age_bucket").glob("run=*"))) == 2
    broken = tmp_path / "fx_age_bucket" / "run=99999999T000000000000"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half written")
    assert tables.read("fx_age_bucket").collect() == [("m", "202401", "30s")]


def _files_of(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


@pytest.mark.parametrize("write", ["upsert", "replace"])
def test_keyed_writes_touch_their_months_only(spark, tmp_path, write):
    tables, folder = Tables(spark, str(tmp_path), keep_runs=1), tmp_path / "fx_age_bucket"
    months = [f"2024{m:02d}" for m in range(1, 7)] + [None, "2024/07"]
    data = [(f"m{i % 10}", months[i // 10], "10s") for i in range(80)]
    tables.write("fx_age_bucket", spark.createDataFrame(data, SCHEMAS["fx_age_bucket"]))
    before = _files_of(folder)
    fresh = spark.createDataFrame([("m1", "202403", "30s"), ("new", "202403", "40s")], SCHEMAS["fx_age_bucket"])
    getattr(tables, write)("fx_age_bucket", fresh, ["ym"])
    after = _files_of(folder)
    same = {p: t for p, t in before.items() if "_part=202403" not in p}
    assert {p: after[p] for p in same} == same and len(same) == 7
    assert all("_part=202403" in p for p in set(after) - set(same)) and not set(before) - set(same) & set(after)
    changed = {("m1", "202403"): "30s", ("new", "202403"): "40s"}
    want = {(s, m): b for s, m, b in data} | changed
    got = {(r["mct_id"], r["ym"]): r["age_bucket"] for r in tables.read("fx_age_bucket").collect()}
    assert got == want and tables.read("fx_age_bucket").count() == 81
    plan = tables.read("fx_age_bucket").select("mct_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<mct_id:string>" in plan


def test_keyed_writes_touch_their_buckets_only(spark, tmp_path):
    tables, folder = Tables(spark, str(tmp_path)), tmp_path / "mat_store_rule_assign"
    rows = [(f"m{i}", 5, i, 0, EARLY) for i in range(200)]
    tables.upsert("mat_store_rule_assign", spark.createDataFrame(rows, SCHEMAS["mat_store_rule_assign"]), ["rule_id"])
    before = _files_of(folder)
    tables.upsert("mat_store_rule_assign", spark.createDataFrame([("m7", 5, 999, 1, LATE)], SCHEMAS["mat_store_rule_assign"]), ["rule_id"])
    fresh = set(_files_of(folder)) - set(before)
    assert len({p.split("_part=")[1].split("/")[0] for p in fresh}) == 1
    got = {r["mct_id"]: r["rule_id"] for r in tables.read("mat_store_rule_assign").collect()}
    assert got == {f"m{i}": 999 if i == 7 else i for i in range(200)}
    empty_rows = spark.createDataFrame([], SCHEMAS["mat_store_rule_assign"])
    tables.upsert("mat_store_rule_assign", empty_rows, ["rule_id"])
    assert tables.read("mat_store_rule_assign").count() == 200
    tables.write("mat_store_rule_assign", empty_rows)
    assert tables.read("mat_store_rule_assign").count() == 0


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The whole pipeline over stored tables, segments run twice."""
    tables = Tables(spark, str(tmp_path_factory.mktemp("tables")))
    for name in ("stg_store", "stg_demo", "stg_perf"):
        tables.write(name, getattr(star, name)(spark, sf_dir))
    features.rebuild(tables)
    association.run(tables, EARLY)
    wide = features.store_features(
        *[tables.read(t) for t in ("fx_age_mix", "fx_audience_type", "fx_perf_flags", "dim_store")]
    )
    media, keywords = load_affinity(
        star.media_by_age(spark, sf_dir), star.interest_span(spark, sf_dir), star.video_by_age(spark, sf_dir), "v1"
    )
    tables.replace("dim_age_affinity_media", media, ["version"])
    tables.replace("dim_age_affinity_keyword", keywords, ["version"])
    segments.run(tables, wide, EARLY, k=3)
    made = segments.run(tables, wide, LATE, k=4)
    explained = [explain.run(tables, wide, ts) for ts in (EARLY, LATE)]
    return tables, wide, made, explained


def test_months_one_by_one_equal_a_rebuild(spark, sf_dir, tmp_path):
    """Features and place sums refreshed by month, with a month that comes later and one that is sent again."""
    staged = {n: getattr(star, n)(spark, sf_dir) for n in ("stg_store", "stg_demo", "stg_perf")}
    whole, by_month = Tables(spark, str(tmp_path / "whole")), Tables(spark, str(tmp_path / "months"))
    clusters = staged["stg_store"].select(F.col("ENCODED_MCT").alias("mct_id"), F.lit(1).alias("cluster_id"), F.lit(5).alias("k"))
    months = sorted(r[0] for r in staged["stg_demo"].select("TA_YM").distinct().collect())
    for tables in (whole, by_month):
        for name, df in staged.items():
            tables.write(name, df)
        tables.write("mat_store_cluster", clusters)
    features.rebuild(whole)
    total = features.refresh_places(whole)
    for some in (months[1:], months[:1], months[2:4]):
        features.rebuild(by_month, some)
        before = _files_of(tmp_path / "months" / "agg_place_month")
        merged = features.refresh_places(by_month, some)
        fresh = set(_files_of(tmp_path / "months" / "agg_place_month")) - set(before)
        assert {p.split("_part=")[1].split("/")[0] for p in fresh} == set(some)
    for name in ("fx_age_mix", "fx_perf_flags", "fx_region_age_avg", "fx_age_bucket", "agg_place_month"):
        assert sorted(map(repr, whole.read(name).collect())) == sorted(map(repr, by_month.read(name).collect())), name
    assert sorted(map(repr, total.collect())) == sorted(map(repr, merged.collect()))
    from patronage.operators.groups import place_sums

    wide = features.store_features(*[whole.read(t) for t in ("fx_age_mix", "fx_audience_type", "fx_perf_flags", "dim_store")])
    direct = place_sums(wide, clusters).select([F.col(c).cast("decimal(38,4)") if c.startswith("sum_") else F.col(c) for c in total.columns])
    merged = merged.select([F.col(c).cast("decimal(38,4)") if c.startswith("sum_") else F.col(c) for c in total.columns])
    assert sorted(map(tuple, direct.collect()), key=repr) == sorted(map(tuple, merged.collect()), key=repr)


def test_age_shares(stored):
    ages = stored[0].read("fx_age_mix")
    total = sum(F.col(c) for c in FEATURES[:5])
    assert ages.filter((F.abs(total - 1) > 0.0003) & (total != 0)).count() == 0


def test_association_history(stored):
    tests = stored[0].read("mat_assoc", history=True)
    assert {r["pair_name"] for r in tests.collect()} == set(association.TESTS)
    assert tests.filter("cramers_v < 0 OR cramers_v > 1 OR p_value < 0 OR p_value > 1").count() == 0


def test_stored_segments(stored):
    tables, wide, made, _ = stored
    clusters = tables.read("mat_store_cluster")
    assert clusters.count() == wide.select("mct_id").distinct().count()
    assert {r["k"] for r in clusters.select("k").distinct().collect()} == {4}
    history = tables.read("mat_cluster_profile", history=True)
    assert {(r["k"], r["created_at"]) for r in history.select("k", "created_at").distinct().collect()} == {(3, EARLY), (4, LATE)}
    per_feature = history.filter("k = 4").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    assert {r["n"] for r in per_feature} == {wide.count()} and len(per_feature) == 12
    newest = wide.groupBy("mct_id").agg(F.max("ym").alias("newest"))
    assert clusters.join(newest, "mct_id").filter("ym <> newest").count() == 0


def test_stored_rules(stored):
    tables, wide, _, explained = stored
    history = tables.read("mat_tree_rules", history=True)
    ids = sorted(r["rule_id"] for r in history.select("rule_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    newest = history.filter(F.col("created_at") == LATE)
    assert newest.agg(F.sum("support")).first()[0] == wide.count() - math.ceil(wide.count() * 0.2)
    assert newest.filter("rule_precision < 1 / k").count() == 0
    assigned = tables.read("mat_store_rule_assign")
    assert assigned.count() == wide.select("mct_id").distinct().count()
    assert assigned.join(newest, "rule_id", "left_anti").count() == 0
    assert assigned.filter(F.col("created_at") != EARLY).count() == 0  # the first write's stamp stays
    assert 0 < explained[1].train_accuracy <= 1 and 0 < explained[1].test_accuracy <= 1


def test_briefs(spark, sf_dir, stored, tmp_path):
    tables, wide, _, _ = stored
    sources = briefs.Sources(
        wide,
        tables.read("stg_store"),
        tables.read("mat_store_cluster"),
        tables.newest("mat_cluster_profile"),
        tables.newest("mat_tree_rules"),
        tables.read("dim_age_affinity_media"),
        tables.read("dim_age_affinity_keyword"),
        "v1",
    )
    shop = wide.first()["mct_id"]
    asked = spark.createDataFrame(
        [
            (1, "NATION_1 BUILDING!! 스**커피", None, None, None, True),
            (2, "무엇", shop, None, None, True),
            (3, "무엇", "unknown", None, None, True),
            (4, "무엇", "unknown", "NATION_2", None, True),
            (5, None, None, "nowhere at all", "/x/", True),
            (6, "NATION_1", None, None, None, False),
        ],
        "request_id long, user_input string, mct_id string, area string, sector string, per_store boolean",
    )
    parsed = briefs.parse_requests(asked, sources.stg_store)
    branches = {r["request_id"]: r["branch"] for r in briefs.route(parsed, sources).collect()}
    assert branches == {1: "group", 2: "store", 3: "cluster", 4: "group", 5: "group", 6: "cluster"}
    grouped = parsed.filter("request_id in (1, 4, 5)")
    direct, stored_sums = (
        briefs.group_briefs(grouped, s, LATE).collect()
        for s in (sources, dataclasses.replace(sources, places=features.refresh_places(tables)))
    )
    assert sorted(map(repr, direct)) == sorted(map(repr, stored_sums)) and len(direct) == 3
    few = briefs.run(tables, asked.filter("request_id = 3"), sources, LATE, k=3, top_media=1, top_kw=2).collect()
    assert sorted(r["mct_id"] for r in few) == [f"CLUSTER::{i}" for i in range(3)]
    assert {(len(r["rec_channels"]), len(r["rec_keywords"])) for r in few} == {(1, 2)}
    made = briefs.run(tables, asked, sources, LATE, extracts_folder=str(tmp_path)).collect()
    by_id = {r["request_id"]: r for r in made if r["request_id"] is not None}
    assert sorted(by_id) == [1, 2, 4, 5]
    assert sorted(r["mct_id"] for r in made if r["request_id"] is None) == [f"CLUSTER::{i}" for i in range(4)]
    assert by_id[1]["context_lines"] == ["area=NATION_1", "sector=BUILDING", "masked_store_name=스**커피"]
    assert by_id[1]["mct_id"] == "GROUP::NATION_1/BUILDING" and by_id[1]["ym"] == "202502"
    assert by_id[1]["title"].startswith("NATION_1/BUILDING | [Cluster ")
    nobody = by_id[5]
    assert nobody["cluster_id"] == 0 and nobody["dom_age"] == "10s" and {nobody[f] for f in FEATURES} == {0.0}
    assert nobody["title"].startswith("nowhere at all//x | [Cluster 0] 10s")
    assert len(by_id[2]["rec_channels"]) == 5 and len(by_id[2]["rec_keywords"]) == 10
    bundle = {r["mct_id"]: json.loads(r["bundle"]) for r in tables.read("mat_prompt_bundle").collect()}
    assert set(bundle) == {r["mct_id"] for r in made}
    for name, place in zip(("bucket", "metric"), bundle["GROUP::NATION_1/BUILDING"]["assets"]):
        file, target = place.split("#target=")
        extract = spark.read.option("header", True).csv(file)
        assert extract.columns == ["target", name, "value"] and extract.filter(F.col("target") == target).count() == 5
    one = bundle[shop]
    assert one["system_prompt"] is None and one["k"] == 4 and list(one["profile"]) == FEATURES
    assert one["user_prompt"].count("\n- \"무엇\"\n") == 1


def test_extracts(spark, tmp_path):
    profile = spark.createDataFrame([(5, 1, *[0.1] * 12)], ["k", "cluster_id", *FEATURES])
    index = briefs.write_extracts(profile, ["k", "cluster_id"], str(tmp_path))
    back = spark.read.option("header", True).csv(f"{tmp_path}/age")
    assert back.count() == 5 and set(back.columns) == {"bucket", "value", "k", "cluster_id"}
    assert index.count() == 1 and index.columns == ["k", "cluster_id", *briefs.EXTRACTS]


def test_extracts_of_many_targets_are_few_files(spark, tmp_path):
    features = [F.lit(i / 20).alias(f) for i, f in enumerate(FEATURES)]
    profiles = spark.range(100_000).select(F.format_string("t%06d", "id").alias("target"), *features)
    index = briefs.write_extracts(profiles, ["target"], str(tmp_path))
    assert index.count() == 100_000 == index.select("target").distinct().count()
    for part in briefs.EXTRACTS:
        files = {r[0] for r in index.select(part).distinct().collect()}
        assert 5 <= len(files) <= 20 and len(list((tmp_path / part).glob("*.csv"))) == len(files)
    one = index.filter("target = 't077777'").first()
    rows = spark.read.option("header", True).csv(one["audience"]).filter("target = 't077777'")
    assert rows.count() == 5


def test_newest_runs_are_found_by_folders(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert tables.newest("mat_tree_rules").count() == 0
    for k, at, ids in ((5, EARLY, [1, 2]), (4, LATE, [3]), (5, LATE, [4, 5]), (6, EARLY, [6])):
        rows = spark.createDataFrame([(i, k) for i in ids], "rule_id long, k int")
        tables.append("mat_tree_rules", rows, at)
    found = tables.newest("mat_tree_rules")
    assert sorted(r["rule_id"] for r in found.collect()) == [3, 4, 5, 6] and found.schema == SCHEMAS["mat_tree_rules"]
    assert tables.read("mat_tree_rules", history=True).count() == 6
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_run_at" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_cells_that_do_not_fit_are_counted(spark, tmp_path):
    for name, table in (("store", "stg_store"), ("perf", "stg_perf"), ("demo", "stg_demo")):
        columns = SCHEMAS[table].names
        rows = [["x"] * len(columns), ["NA"] * len(columns), ["1"] * len(columns)]
        (tmp_path / f"{name}.csv").write_text("\n".join(",".join(r) for r in [columns, *rows]) + "\n")
    tables = Tables(spark, str(tmp_path / "tables"))
    found = tables.load_staging(*[str(tmp_path / f"{n}.csv") for n in ("store", "perf", "demo")])
    for table, counts in found.items():
        for f in SCHEMAS[table].fields:
            want = 0 if isinstance(f.dataType, T.StringType) else 2 if isinstance(f.dataType, T.DateType) else 1
            assert counts[f.name] == want, (table, f.name)
        assert tables.read(table).count() == 3


def test_conform_fills_absent_columns(spark):
    made = conform(spark.createDataFrame([("m",)], "mct_id string"), "mat_store_cluster")
    assert made.schema == SCHEMAS["mat_store_cluster"] and made.first()["k"] is None


def test_feature_steps_are_short_enough_to_be_compiled(spark, sf_dir, capsys):
    """The JVM leaves methods of more than 8,000 bytes of code uncompiled."""
    rows = features.store_features_from_months(star.staged_months(spark, sf_dir), star.stg_store(spark, sf_dir))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_only_bundles_that_are_kept_become_json(spark):
    rows = spark.range(4).select(
        F.col("id").alias("request_id"), F.lit("a").alias("mct_id"), F.lit("202501").alias("ym"),
        *[F.col("id").alias(c) for c in briefs.BRIEF_COLUMNS[3:]],
    )
    made = briefs.bundles(rows, "v")
    plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
    kept = next(i for i, line in enumerate(plan) if "Aggregate" in line)
    assert not any("json" in line for line in plan[kept + 1 :])
    assert [json.loads(b)["k"] for b, in made.select("bundle").collect()] == [3]
