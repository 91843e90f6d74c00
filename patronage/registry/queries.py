"""Registered queries: each takes (spark, sf_dir) and reads whole tables below sf_dir."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions.numbers import round_half_even
from ..functions.text import age_group, masked_tokens, normalize_text, parse_ratio, road_name, span_age_group
from ..operators import affinity, clustering, keyed, ranking, silhouette
from ..operators import rules as tree_rules
from ..operators.crosstab import crosstab
from ..operators.groups import attach, group_profiles, place_sums
from ..operators.matching import like_matches, longest_names, name_list, vocabulary
from ..plans import affinity as affinity_job
from ..plans import association, briefs, explain, features, segments
from ..schemas import AUD_COLS, AUDIENCES, FEATURES
from ..session import cut_lineage, scratch_path
from ..sources import star
from ..sources.delimited import lost, read_text_csv, typed, write_charsets
from ..sources.star import read_table as _table
from ..sources.tables import Tables

RUN_TS = dt.datetime(2025, 10, 1)
EARLIER_TS = dt.datetime(2025, 7, 1)
VERSION = "v1_2025Q3"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The result with decimals as doubles and integers as longs."""
        df = run(spark, sf_dir)
        casts = {T.DecimalType: "double", T.IntegerType: "long", T.FloatType: "double"}
        return df.select(
            [F.col(f.name).cast(casts[type(f.dataType)]) if type(f.dataType) in casts else F.col(f.name) for f in df.schema]
        )

    REGISTRY[run.__name__] = plain
    return run


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.store_features_from_months(star.staged_months(spark, sf_dir), star.stg_store(spark, sf_dir))


# --- features --------------------------------------------------------------------------------------


@query
def dim_store(spark, sf_dir):
    stores = features.dim_store(star.stg_store(spark, sf_dir))
    return stores.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("open_dt", "close_dt")})


@query
def road_names(spark, sf_dir):
    return star.stg_store(spark, sf_dir).select("ENCODED_MCT", road_name("MCT_BSE_AR").alias("road_name"))


@query
def age_mix(spark, sf_dir):
    return features.age_mix(star.stg_demo(spark, sf_dir))


@query
def audience_type(spark, sf_dir):
    return features.audience_type(star.stg_demo(spark, sf_dir))


@query
def perf_flags(spark, sf_dir):
    return features.perf_flags(star.stg_perf(spark, sf_dir))


@query
def region_age_avg(spark, sf_dir):
    return features.region_age_avg(features.age_mix(star.stg_demo(spark, sf_dir)), star.stg_store(spark, sf_dir))


@query
def store_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def store_features_joined(spark, sf_dir):
    """The same rows by way of the separate feature tables."""
    demo = star.stg_demo(spark, sf_dir)
    return features.store_features(
        features.age_mix(demo),
        features.audience_type(demo),
        features.perf_flags(star.stg_perf(spark, sf_dir)),
        features.dim_store(star.stg_store(spark, sf_dir)),
    )


@query
def store_features_latest(spark, sf_dir):
    return features.store_features_from_months(
        star.staged_months(spark, sf_dir), star.stg_store(spark, sf_dir), latest_only=True
    )


@query
def store_features_staged(spark, sf_dir):
    """The same rows by way of the two staging tables."""
    return features.store_features_from_staging(
        star.stg_demo(spark, sf_dir), star.stg_perf(spark, sf_dir), star.stg_store(spark, sf_dir)
    )


@query
def age_bucket(spark, sf_dir):
    return features.age_bucket(features.age_mix(star.stg_demo(spark, sf_dir)))


@query
def aud_bucket(spark, sf_dir):
    return features.aud_bucket(features.audience_type(star.stg_demo(spark, sf_dir)))


# --- association -----------------------------------------------------------------------------------


def _assoc_rows(spark, sf_dir):
    return association.dataset_from_features(_features(spark, sf_dir))


@query
def assoc_dataset_joined(spark, sf_dir):
    """The same rows by way of the stored bucket and flag tables."""
    demo = star.stg_demo(spark, sf_dir)
    return association.dataset(
        features.age_bucket(features.age_mix(demo)),
        features.aud_bucket(features.audience_type(demo)),
        features.perf_flags(star.stg_perf(spark, sf_dir)),
    )


@query
def assoc_dataset(spark, sf_dir):
    return _assoc_rows(spark, sf_dir)


@query
def crosstab_age_aud(spark, sf_dir):
    return crosstab(_assoc_rows(spark, sf_dir), "age_bucket", "aud_bucket", AUDIENCES)


@query
def crosstab_age_cancel(spark, sf_dir):
    return crosstab(_assoc_rows(spark, sf_dir), "age_bucket", "cancel_high", ["0", "1"])


@query
def crosstab_aud_delivery(spark, sf_dir):
    return crosstab(_assoc_rows(spark, sf_dir), "aud_bucket", "delivery_high", ["0", "1"])


@query
def assoc_tests(spark, sf_dir):
    tested = association.run_tests(_assoc_rows(spark, sf_dir))
    return tested.withColumns({c: F.round(c, 8) for c in ("chi2", "p_value", "cramers_v")})


@query
def assoc_two_by_two(spark, sf_dir):
    """Both flags against each other: one degree of freedom, with continuity correction."""
    tests = {"cancel_high~delivery_high": ("cancel_high", "delivery_high")}
    tested = association.run_tests(_assoc_rows(spark, sf_dir), tests)
    return tested.withColumns({c: F.round(c, 8) for c in ("chi2", "p_value", "cramers_v")})


# --- keyed writes ----------------------------------------------------------------------------------


def _stored_buckets(spark, sf_dir):
    buckets = features.age_bucket(features.age_mix(star.stg_demo(spark, sf_dir)))
    return buckets.withColumn("loaded", F.lit("first"))


def _order_rows(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("mct_id"),
        F.date_format("o_orderdate", "yyyyMM").alias("ym"),
        F.col("o_orderpriority").alias("age_bucket"),
        F.col("o_orderkey"),
    )


@query
def upsert_rows(spark, sf_dir):
    """Orders over the stored buckets: the bucket is overwritten, the load mark stays."""
    source = _order_rows(spark, sf_dir).withColumn("loaded", F.concat(F.lit("order "), F.col("o_orderkey")))
    return keyed.upsert(_stored_buckets(spark, sf_dir), source, ["mct_id", "ym"], ["o_orderkey"], ["age_bucket"])


@query
def replace_rows(spark, sf_dir):
    """Orders over the stored buckets: the whole row goes, and with it the load mark."""
    return keyed.replace(
        _stored_buckets(spark, sf_dir), _order_rows(spark, sf_dir), ["mct_id", "ym"], ["o_orderkey"]
    )


@query
def dedupe_last(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    return keyed.dedupe_last(orders, ["o_custkey"], ["day", "o_orderkey"])


@query
def backfill_update(spark, sf_dir):
    store = star.stg_store(spark, sf_dir).select("ENCODED_MCT", "HPSN_MCT_ZCD_NM", "MCT_BRD_NUM")
    return keyed.backfill(store, "MCT_BRD_NUM", F.lit("NONE"), F.col("HPSN_MCT_ZCD_NM") == "BUILDING")


# --- sources ---------------------------------------------------------------------------------------


@query
def csv_null_tokens(spark, sf_dir):
    """Customers written as CSV with missing words in them and read back."""
    word = (
        F.when(F.col("c_mktsegment") == "BUILDING", "NA")
        .when(F.col("c_mktsegment") == "MACHINERY", "null")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "")
        .otherwise(F.concat("c_mktsegment", F.lit(', "'), "c_name", F.lit('"')))
    )
    path = scratch_path(spark, "csv")
    rows = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), word.alias("word"), F.lit("가게").alias("한글")
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return read_text_csv(spark, path)


def _order_texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, T.StructType]:
    """Orders as texts, some of which don't fit the declared types, and these types."""
    priced = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    texts = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyyMMdd"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy/M/d"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yy.MM.dd"))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyyMMdd 'x'"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("day"),
        F.when(F.col("o_orderstatus") == "F", "x").otherwise(priced).alias("amount"),
        priced.alias("ratio"),
    )
    schema = T.StructType.fromDDL("id bigint, day date, amount decimal(12,2), ratio decimal(6,4), absent string")
    return texts, schema


@query
def typed_cast(spark, sf_dir):
    """Texts cast to declared types; what does not fit is NULL."""
    return typed(*_order_texts(spark, sf_dir)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query
def typed_cast_lost(spark, sf_dir):
    """By column how many of these texts did not fit."""
    texts, schema = _order_texts(spark, sf_dir)
    counts = lost(texts, schema)
    wide = texts.agg(*[c.alias(n) for n, c in counts.items()])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("n")) for n in counts])))


@query
def charset_mixed(spark, sf_dir):
    """Part names with Korean text as CSV, one file in UTF-8 and one in cp949, read from their folder."""
    folder = scratch_path(spark, "charsets")
    parts = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("key"), F.concat(F.lit("상품 \""), "p_name", F.lit("\", "), "p_type").alias("이름")
    )
    odd = F.col("key").cast("long") % 2 == 1
    write_charsets(parts, {"utf8": ~odd, "cp949": odd}, folder)
    return read_text_csv(spark, f"{folder}/*").select(F.col("key").cast("long").alias("key"), F.col("이름").alias("name"))


@query
def table_reload(spark, sf_dir):
    """Staging tables written to CSV, loaded into stored tables, features rebuilt, read back."""
    folder = scratch_path(spark, "reload")
    staged = {
        "store": star.stg_store(spark, sf_dir),
        "perf": star.stg_perf(spark, sf_dir),
        "demo": star.stg_demo(spark, sf_dir),
    }
    for name, df in staged.items():
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    tables = Tables(spark, f"{folder}/tables")
    tables.load_staging(f"{folder}/store", f"{folder}/perf", f"{folder}/demo")
    features.rebuild(tables)
    return tables.read("fx_region_age_avg")


# --- loosely written values --------------------------------------------------------------------------


@query
def map_age(spark, sf_dir):
    size, kind = F.col("p_size").cast("string"), F.col("p_type")
    label = (
        F.when(kind == "PROMO", F.concat(F.lit(" "), size, F.lit("대 ")))
        .when(kind == "SMALL", F.concat(size, F.lit("0대")))
        .when(kind == "LARGE", F.concat(F.lit("TEENS "), "p_name"))
        .when(kind == "MEDIUM", F.concat("p_name", F.lit(" 이상")))
        .when(kind == "ECONOMY", F.concat(F.lit("age "), size, F.lit("-"), (F.col("p_size") + 9).cast("string")))
        .otherwise(F.col("p_name"))
    )
    return _table(spark, sf_dir, "part").select("p_partkey", age_group(label).alias("age_group"))


@query
def as_ratio(spark, sf_dir):
    size, flag = F.col("l_quantity").cast("int").cast("string"), F.col("l_returnflag")
    cell = (
        F.when(flag == "A", F.concat(F.lit(" "), size, F.lit(" %")))
        .when((flag == "R") & (F.col("l_linestatus") == "O"), F.concat(F.lit("0."), size))
        .when(flag == "R", F.concat(F.lit("1,"), size))
        .when(F.col("l_linestatus") == "O", F.concat(size, F.lit(".5%")))
        .when(F.col("l_quantity") <= 10, "-")
        .when(F.col("l_quantity") <= 20, "-999999.9")
        .when(F.col("l_quantity") <= 30, F.concat(size, F.lit("e-3")))
        .when(F.col("l_quantity") <= 40, F.concat(size, F.lit("d")))
        .otherwise("NaN")
    )
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", cell.alias("cell")
    ).select("l_orderkey", "l_partkey", "l_linenumber", parse_ratio("cell").alias("ratio"))


@query
def age_span_bucket(spark, sf_dir):
    """Ages as plain numbers, with suffixes that are no part of one, and with digit separators."""
    kind, low = F.col("매체2"), F.col("최소나이")
    written = F.when(kind == "PROMO", F.concat(low, F.lit("d"))).when(kind == "SMALL", F.concat(F.lit(" +"), low, F.lit("_0 ")))
    rows = star.media_span(spark, sf_dir).withColumn("최소나이", F.coalesce(written, low))
    return rows.select("row_ord", span_age_group("최소나이", "최대나이").alias("age_group"))


@query
def normalized_texts(spark, sf_dir):
    """Whole texts of documents, conversation turns and requests, normalised."""
    documents = _table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text"
    )
    turns = _table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("/"), "turn").alias("id"), "text"
    )
    asked = star.requests(spark, sf_dir).select(
        F.concat(F.lit("r"), "request_id").alias("id"), F.col("user_input").alias("text")
    )
    texts = documents.unionByName(turns).unionByName(asked)
    return texts.select("id", normalize_text("text").alias("text_norm"))


@query
def masked_words(spark, sf_dir):
    """Masked names in whole documents and requests."""
    documents = _table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text"
    )
    asked = star.requests(spark, sf_dir).select(
        F.concat(F.lit("r"), "request_id").alias("id"), F.col("user_input").alias("text")
    )
    return documents.unionByName(asked).select("id", masked_tokens(normalize_text("text")).alias("masked"))


# --- affinity --------------------------------------------------------------------------------------


@query
def affinity_by_age(spark, sf_dir):
    return affinity.media_affinity(star.media_by_age(spark, sf_dir))


@query
def affinity_by_span(spark, sf_dir):
    return affinity.media_affinity(star.media_span(spark, sf_dir))


@query
def affinity_name_pairs(spark, sf_dir):
    return affinity.interest_affinity(star.interest_span(spark, sf_dir))


@query
def affinity_keyword_by_age(spark, sf_dir):
    """Keywords in rows, one column per age."""
    return affinity.interest_affinity(star.keyword_by_age(spark, sf_dir))


@query
def affinity_stored(spark, sf_dir):
    """Affinity inputs written to CSV, loaded by the job into stored tables over an earlier load of the
    same version, read back."""
    folder = scratch_path(spark, "affinity")
    made = {"media": star.media_by_age, "interest": star.interest_span, "video": star.video_by_age}
    for name, build in made.items():
        rows = build(spark, sf_dir).drop("row_ord")
        rows.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    tables = Tables(spark, f"{folder}/tables")
    paths = {name: f"{folder}/{name}" for name in made}
    affinity_job.run(tables, {"media": paths["media"], "interest": paths["interest"]}, VERSION)
    affinity_job.run(tables, paths, VERSION)
    media, keywords = tables.read("dim_age_affinity_media"), tables.read("dim_age_affinity_keyword")
    both = media.withColumnRenamed("channel", "item").withColumn("kind", F.lit("channel")).unionByName(
        keywords.withColumnRenamed("keyword", "item").withColumn("kind", F.lit("keyword"))
    )
    return both.select("version", "kind", "age_group", "item", "affinity")


@query
def affinity_transpose(spark, sf_dir):
    return affinity.video_affinity(star.video_transposed(spark, sf_dir))


def _affinity(spark, sf_dir):
    return affinity.load_affinity(
        star.media_by_age(spark, sf_dir), star.interest_span(spark, sf_dir), star.video_by_age(spark, sf_dir), VERSION
    )


@query
def affinity_merge(spark, sf_dir):
    return _affinity(spark, sf_dir)[0]


@query
def top_media(spark, sf_dir):
    return ranking.top_per_group(_affinity(spark, sf_dir)[0], ["version", "age_group"], "affinity", "channel", 5)


@query
def top_keywords(spark, sf_dir):
    return ranking.top_per_group(_affinity(spark, sf_dir)[1], ["version", "age_group"], "affinity", "keyword", 10)


# --- models on given labels -------------------------------------------------------------------------


@query
def standardize(spark, sf_dir):
    scaled = clustering.standardize(_features(spark, sf_dir), FEATURES, ["mct_id", "ym"])
    return scaled.withColumns({f: F.expr(f"round({f}, 6) + 0D") for f in FEATURES})


def _centers(points: DataFrame) -> DataFrame:
    """Mean vector per given label."""
    long = points.select("label", F.posexplode("embedding").alias("dim", "x"))
    means = long.groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    packed = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("_x"))
    return packed.select(F.col("label").alias("cluster_id"), F.transform("_x", lambda e: e["x"]).alias("center"))


@query
def nearest_center(spark, sf_dir):
    points = _table(spark, sf_dir, "embeddings")
    near = clustering.nearest_center(points, "embedding", _centers(points))
    return near.select("vec_id", "cluster_id", F.round("squared_distance", 6).alias("squared_distance"))


@query
def inertia_fixed(spark, sf_dir):
    points = _table(spark, sf_dir, "embeddings")
    near = clustering.nearest_center(points, "embedding", _centers(points))
    return near.agg(F.round(F.sum("squared_distance"), 6).alias("inertia"))


def _labelled_points(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    points = _table(spark, sf_dir, "embeddings")
    dims = [f"x{i}" for i in range(len(points.select("embedding").first()[0]))]
    wide = points.select(
        F.col("label"), F.lit(1).alias("weight"), *[F.col("embedding")[i].cast("double").alias(d) for i, d in enumerate(dims)]
    )
    return silhouette.numbered(wide, "point_id"), dims


@query
def silhouette_fixed(spark, sf_dir):
    points, dims = _labelled_points(spark, sf_dir)
    score = silhouette.euclidean(points, "point_id", dims, ["label"], "weight")["label"]
    return points.agg(F.round(F.lit(score), 8).alias("silhouette"), F.count("*").alias("n"))


@query
def silhouette_squared(spark, sf_dir):
    points, dims = _labelled_points(spark, sf_dir)
    score = silhouette.squared(points, dims, ["label"], "weight")["label"]
    return points.agg(F.round(F.lit(score), 8).alias("silhouette"), F.count("*").alias("n"))


@query
def silhouette_one_label(spark, sf_dir):
    """All embeddings under one label, beside their own ones: -1 by definition."""
    points, dims = _labelled_points(spark, sf_dir)
    both = points.withColumn("one", F.lit(0))
    score = silhouette.squared(both, dims, ["one", "label"], "weight")
    return both.agg(F.lit(score["one"]).alias("one"), F.round(F.lit(score["label"]), 8).alias("own"), F.count("*").alias("n"))


def _given_clusters(rows: DataFrame) -> DataFrame:
    """A labelling that SQL can repeat: place of the dominant age band in the newest month."""
    bucket = F.array_position(F.array(*[F.lit(b) for b in ("10s", "30s", "40s", "50s", "60p")]), features.dominant_age())
    newest = rows.groupBy("mct_id").agg(F.max_by(F.struct("ym", *FEATURES), "ym").alias("_row")).select("mct_id", "_row.*")
    return newest.select(
        "mct_id",
        "ym",
        (bucket - 1).cast("int").alias("cluster_id"),
        F.lit(5).alias("k"),
        F.lit(0.0).alias("inertia"),
        F.lit(0.0).alias("silhouette"),
        F.lit("squared").alias("measure"),
        F.lit(RUN_TS).alias("created_at"),
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows with the given label, written once: every user of them reads them twice."""
    rows = cut_lineage(_features(spark, sf_dir))
    return cut_lineage(explain.labelled_rows(_given_clusters(rows), rows))


def _given_profile(labelled: DataFrame) -> DataFrame:
    """Profiles of two runs of the same k; the earlier one saw rows with neither flag only."""
    now = clustering.cluster_profile(labelled, FEATURES)
    before = clustering.cluster_profile(labelled.filter((F.col("cancel_high") == 0) & (F.col("delivery_high") == 0)), FEATURES)
    stamped = [p.withColumn("created_at", F.lit(ts)) for p, ts in ((now, RUN_TS), (before, EARLIER_TS))]
    return stamped[0].unionByName(stamped[1]).withColumn("k", F.lit(5))


def _given_rules(labelled: DataFrame) -> DataFrame:
    """Rules of two runs. In the newer one a rule per strongest audience and cancel flag, with
    data-derived support and precision; in the older one the same rules, certain, for other clusters."""
    leaf = F.concat_ws(
        " ", features.first_largest(AUDIENCES, AUD_COLS), F.col("cancel_high").cast("int").cast("string")
    )
    stats = tree_rules.leaf_stats(labelled.withColumn("leaf", leaf), "leaf", "cluster_id")
    rules = stats.select(
        F.dense_rank().over(W.orderBy("leaf")).cast("long").alias("rule_id"),
        F.lit(5).alias("k"),
        F.when(F.col("leaf").startswith("NEW"), 1).otherwise(2).alias("depth"),
        "cluster_id",
        F.col("leaf").alias("rule_text"),
        "support",
        F.round("rule_precision", 2).alias("rule_precision"),
        F.lit(RUN_TS).alias("created_at"),
    )
    older = {
        "rule_id": F.col("rule_id") + 100,
        "cluster_id": 4 - F.col("cluster_id"),
        "rule_text": F.concat(F.lit("old "), F.col("rule_text")),
        "rule_precision": F.lit(1.0),
        "created_at": F.lit(EARLIER_TS),
    }
    return rules.unionByName(rules.withColumns(older))


@query
def cluster_profile(spark, sf_dir):
    profile = clustering.cluster_profile(_labelled(spark, sf_dir), FEATURES)
    return profile.withColumn("std", F.round("std", 6))


@query
def profile_pivot(spark, sf_dir):
    return clustering.pivot_profile(_given_profile(_labelled(spark, sf_dir)), FEATURES)


@query
def latest_k(spark, sf_dir):
    """Orders as runs: the number of the order's priority stands for k, the order date for run time."""
    runs = _table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("created_at"), F.substring("o_orderpriority", 1, 1).cast("int").alias("k")
    )
    return ranking.latest_k(runs)


@query
def stratified_counts(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    train, test = tree_rules.stratified_split(rows, "cluster_id", ["mct_id", "ym"])
    parts = train.select("cluster_id", F.lit(0).alias("t")).unionByName(test.select("cluster_id", F.lit(1).alias("t")))
    return parts.groupBy("cluster_id").agg(F.count_if(F.col("t") == 0).alias("n_train"), F.sum("t").alias("n_test"))


# Fixed tests over the features: a small tree, every row meets exactly one path.
_PATHS = [
    (1, [("aud_new", 0.5, "<="), ("age_40s", 0.25, "<=")]),
    (2, [("aud_new", 0.5, "<="), ("age_40s", 0.25, ">")]),
    (3, [("aud_new", 0.5, ">"), ("cancel_high", 0.5, "<=")]),
    (4, [("aud_new", 0.5, ">"), ("cancel_high", 0.5, ">")]),
]


def _rule_rows(spark, sf_dir):
    rules = spark.createDataFrame(_PATHS, f"rule_id int, path {tree_rules.PATH_TYPE}")
    return tree_rules.matching_rules(_labelled(spark, sf_dir), rules, FEATURES)


@query
def rule_membership(spark, sf_dir):
    return _rule_rows(spark, sf_dir).select("mct_id", "ym", "rule_id")


@query
def rule_stats(spark, sf_dir):
    return tree_rules.leaf_stats(_rule_rows(spark, sf_dir), "rule_id", "cluster_id")


@query
def best_rule(spark, sf_dir):
    rules = ranking.newest_runs(_given_rules(_labelled(spark, sf_dir)))
    return ranking.best_rules(rules).drop("created_at")


@query
def stored_rules_newest(spark, sf_dir):
    """Rules of two runs appended to the stored history, the older one last, and the newest read back."""
    tables = Tables(spark, scratch_path(spark, "history"))
    rules = cut_lineage(_given_rules(_labelled(spark, sf_dir)))
    for run_ts in (RUN_TS, EARLIER_TS):
        tables.append("mat_tree_rules", rules.filter(F.col("created_at") == F.lit(run_ts)), run_ts)
    return tables.newest("mat_tree_rules").select("rule_id", "k", "depth", "cluster_id", "rule_text", "support", "rule_precision")


@query
def stored_profile(spark, sf_dir):
    """Segments of two runs stored; of the newest profile, per feature, its rows and the mean over all
    clusters, which are those of all shop months."""
    tables = Tables(spark, scratch_path(spark, "segments"))
    rows = cut_lineage(_features(spark, sf_dir))
    for run_ts, k in ((EARLIER_TS, 4), (RUN_TS, 4)):
        segments.run(tables, rows, run_ts, k=k)
    profile = tables.newest("mat_cluster_profile")
    return profile.groupBy("k", "feature").agg(F.sum("n").alias("n"), F.round(F.sum(F.col("mean") * F.col("n")) / F.sum("n"), 6).alias("mean"))


@query
def accuracy(spark, sf_dir):
    """Share of rows whose rule's majority cluster is their own."""
    rows = _rule_rows(spark, sf_dir)
    majority = tree_rules.leaf_stats(rows, "rule_id", "cluster_id").select("rule_id", F.col("cluster_id").alias("predicted"))
    return tree_rules.accuracy(rows.join(majority, "rule_id"), "cluster_id", "predicted")


def _given_tree(spark: SparkSession, sf_dir: str):
    """The rows of the given clusters, a tree over all of them, and its rules."""
    rows = _labelled(spark, sf_dir)
    fitted = tree_rules.fit_tree(rows, FEATURES, "cluster_id")
    return rows, fitted, tree_rules.extract_rules(fitted, spark)


@query
def tree_rules_given(spark, sf_dir):
    """Every rule of the tree that explains the given clusters, with its text, support and precision."""
    return _given_tree(spark, sf_dir)[2].drop("path", "leaf")


@query
def tree_assign_given(spark, sf_dir):
    """Every shop month with its rule and the cluster that the rule predicts."""
    rows, fitted, rules = _given_tree(spark, sf_dir)
    return tree_rules.assign_rules(fitted, rules, rows).select("mct_id", "ym", "rule_id", "rule_cluster")


# --- requests and briefs ------------------------------------------------------------------------------


@query
def vocab(spark, sf_dir):
    return vocabulary(star.stg_store(spark, sf_dir))


@query
def longest_match(spark, sf_dir):
    names = name_list(star.stg_store(spark, sf_dir))
    return longest_names(star.requests(spark, sf_dir), "request_id", "user_input", names)


@query
def names_in_documents(spark, sf_dir):
    """The longest name in each whole document; names are the opening words of all texts of the benchmark."""
    first = F.lower(F.substring_index("text", " ", 1))
    names = _table(spark, sf_dir, "benchmark").select(F.lit("word").alias("kind"), first.alias("name"))
    names = names.filter("name <> ''").distinct()
    return longest_names(_table(spark, sf_dir, "documents"), "doc_id", "text", names)


@query
def like_filter(spark, sf_dir):
    """Names of nations as patterns over all customer and part names; ``_`` is a wildcard."""
    params = _table(spark, sf_dir, "nation").select(F.concat(F.lower(F.substring("n_name", 1, 3)), F.lit("%"), F.expr("substring(n_name, 8)")).alias("param"))
    sizes = _table(spark, sf_dir, "part").select(F.concat(F.lit("Nation "), "p_name", F.lit(" "), "p_size").alias("value"))
    return like_matches(params, sizes)


@query
def parsed_requests(spark, sf_dir):
    parsed = briefs.parse_requests(star.requests(spark, sf_dir), star.stg_store(spark, sf_dir))
    return parsed.select("request_id", "mct_id", "text_norm", "area", "sector", "masked_name")


def _asked_groups(spark, sf_dir):
    return briefs.parse_requests(star.requests(spark, sf_dir), star.stg_store(spark, sf_dir)).filter(
        F.col("area").isNotNull() | F.col("sector").isNotNull()
    )


@query
def group_mean(spark, sf_dir):
    rows = cut_lineage(_features(spark, sf_dir))
    answers = group_profiles(_asked_groups(spark, sf_dir), place_sums(rows, _given_clusters(rows)))
    return answers.select("area", "sector", "n", *FEATURES)


@query
def representative_cluster(spark, sf_dir):
    rows = cut_lineage(_features(spark, sf_dir))
    asked = _asked_groups(spark, sf_dir)
    answers = group_profiles(asked, place_sums(rows, _given_clusters(rows)))
    return attach(asked.select("request_id", "area", "sector"), answers.select("area", "sector", "cluster_id"))


def _sources(spark, sf_dir, profile: bool = False, lists: bool = True) -> briefs.Sources:
    """The tables behind the briefs. The feature rows are written once, since several jobs read them;
    profiles and the lists of rules and affinities are made only where a branch asks for them."""
    rows = cut_lineage(_features(spark, sf_dir))
    clusters = _given_clusters(rows)
    labelled = cut_lineage(explain.labelled_rows(clusters, rows)) if lists else None
    media, keywords = _affinity(spark, sf_dir) if lists else (None, None)
    return briefs.Sources(
        features=rows,
        stg_store=star.stg_store(spark, sf_dir),
        clusters=clusters,
        profile=_given_profile(labelled) if profile else None,
        rules=_given_rules(labelled) if lists else None,
        media=media,
        keywords=keywords,
        version=VERSION,
    )


def _listed(df: DataFrame, *keys: str) -> DataFrame:
    """Brief rows with the nested parts as text."""

    def listing(items: str, name: str):
        text = f"concat(e.{name}, ':', format_string('%.4f', e.affinity))"
        return F.expr(f"array_join(transform({items}, e -> {text}), ',')")

    return df.select(
        *keys,
        *["k", "cluster_id", "title", "user_prompt", "rule_text", "dom_age"],
        listing("rec_channels", "channel").alias("channels"),
        listing("rec_keywords", "keyword").alias("keywords"),
        F.array_join("context_lines", "|").alias("context"),
    )


def _shown(df: DataFrame) -> DataFrame:
    return _listed(df, "request_id", "mct_id", "ym")


@query
def request_branch(spark, sf_dir):
    sources = _sources(spark, sf_dir, lists=False)
    parsed = briefs.parse_requests(star.requests(spark, sf_dir), sources.stg_store)
    return briefs.route(parsed, sources).select("request_id", "branch")


@query
def store_brief(spark, sf_dir):
    sources = _sources(spark, sf_dir)
    parsed = briefs.parse_requests(star.requests(spark, sf_dir), sources.stg_store)
    return _shown(briefs.store_briefs(parsed, sources))


@query
def group_brief(spark, sf_dir):
    sources = _sources(spark, sf_dir)
    return _shown(briefs.group_briefs(_asked_groups(spark, sf_dir), sources, RUN_TS))


@query
def cluster_brief(spark, sf_dir):
    return _shown(briefs.cluster_briefs(_sources(spark, sf_dir, profile=True), RUN_TS)).drop("request_id", "context")


@query
def brief_json(spark, sf_dir):
    """All requests answered by their branch, as stored JSON rows: the fields of each document."""
    sources = _sources(spark, sf_dir, profile=True)
    stored = briefs.bundles(briefs.answer(star.requests(spark, sf_dir), sources, RUN_TS), VERSION)
    return stored.select("mct_id", "ym", "version", F.array_join(F.json_object_keys("bundle"), ",").alias("fields"))


@query
def brief_bundles(spark, sf_dir):
    """The stored JSON rows of all requests, read back field by field."""
    sources = _sources(spark, sf_dir, profile=True)
    stored = briefs.bundles(briefs.answer(star.requests(spark, sf_dir), sources, RUN_TS), VERSION)
    item = "struct<channel:string,keyword:string,affinity:double>"
    fields = (
        "k int, cluster_id int, title string, system_prompt string, user_prompt string, rule_text string,"
        f" dom_age string, rec_channels array<{item}>, rec_keywords array<{item}>, context_lines array<string>,"
        f" profile struct<{','.join(f'{c}:double' for c in FEATURES)}>, user_input string"
    )
    read = stored.select("mct_id", "ym", "version", F.from_json("bundle", fields).alias("_b")).select("*", "_b.*").drop("_b")
    values = ", ".join(f"format_string('%.12f', profile.{c})" for c in FEATURES)
    read = read.withColumn("profile", F.expr(f"concat_ws(',', {values})"))
    return _listed(read, "mct_id", "ym", "version", "system_prompt", "profile", "user_input")


def _profiles(spark, sf_dir):
    return clustering.pivot_profile(_given_profile(_labelled(spark, sf_dir)), FEATURES)


@query
def chart_age(spark, sf_dir):
    """Age bars of every shop month."""
    return briefs.chart_age(_features(spark, sf_dir), ["mct_id", "ym"])


@query
def chart_audience(spark, sf_dir):
    """Strong audiences of every shop month."""
    return briefs.chart_audience(_features(spark, sf_dir), ["mct_id", "ym"])


@query
def profile_extract_age(spark, sf_dir):
    return briefs.profile_extract(_profiles(spark, sf_dir), ["cluster_id"], "age")


@query
def profile_extract_audience(spark, sf_dir):
    return briefs.profile_extract(_profiles(spark, sf_dir), ["cluster_id"], "audience")


@query
def rounded_shares(spark, sf_dir):
    """Discounted prices rounded by their binary value, as number texts do."""
    lines = _table(spark, sf_dir, "lineitem")
    value = (F.col("l_extendedprice") * F.col("l_discount")).alias("v")
    rows = lines.select("l_orderkey", "l_partkey", "l_linenumber", value)
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", round_half_even("v", 2).alias("v2"), round_half_even("v", 3).alias("v3")
    )


# --- fitted models: what holds for every fit -------------------------------------------------------------


@query
def kmeans_choose_k(spark, sf_dir):
    """Each k that was tried: rows, whether the inertia is that of the centres, and whether one k is
    chosen that has the top silhouette."""
    rows = cut_lineage(_features(spark, sf_dir))
    best, found = clustering.choose_segments(rows, FEATURES)
    scaled = clustering.fill_missing(rows, FEATURES).select(*best.scaler.columns())
    nearest = [F.sum(s.nearest()["distance"]).alias(f"k{s.k}") for s in found]
    sums = scaled.agg(F.count("*").alias("n"), *nearest).first()
    top = max(s.silhouette for s in found)
    values = [
        (s.k, sums["n"], abs(s.inertia - sums[f"k{s.k}"]) <= 1e-9 * s.inertia, best.silhouette == top and best in found)
        for s in found
    ]
    return spark.createDataFrame(values, "k int, n long, inertia_of_centers boolean, chosen_is_best boolean")


def _segmented(spark, sf_dir):
    rows = cut_lineage(_features(spark, sf_dir))
    return rows, segments.segment(rows, RUN_TS, k=5)


@query
def store_clusters(spark, sf_dir):
    """Every shop's newest month, and whether the centre of the shop's cluster is the nearest to it."""
    rows, made = _segmented(spark, sf_dir)
    scaled = clustering.fill_missing(rows, FEATURES).select("mct_id", "ym", *made.segments.scaler.columns())
    near = scaled.select("mct_id", "ym", made.segments.nearest()["cluster_id"].alias("_near"))
    joined = made.clusters.join(near, ["mct_id", "ym"])
    return joined.select("mct_id", "ym", (F.col("_near") == F.col("cluster_id")).alias("nearest"))


def _explained(spark, sf_dir):
    rows, made = _segmented(spark, sf_dir)
    return rows, explain.explain(cut_lineage(made.clusters), rows, RUN_TS)


@query
def fitted_rules(spark, sf_dir):
    """All rules of a fit: training rows they cover, leaf size, depth, and ids without a gap."""
    rules = _explained(spark, sf_dir)[1].rules
    return rules.agg(
        F.sum("support").alias("support"),
        (F.min("support") >= 50).alias("full_leaves"),
        (F.max("depth") <= 3).alias("shallow"),
        ((F.min("rule_id") == 1) & (F.max("rule_id") == F.count("*")) & (F.count_distinct("rule_id") == F.count("*"))).alias(
            "no_gap"
        ),
    )


@query
def rule_assign(spark, sf_dir):
    """Every shop with whether its newest month meets all tests of the rule it was given."""
    rows, made = _explained(spark, sf_dir)
    newest = clustering.fill_missing(rows, FEATURES).groupBy("mct_id").agg(F.max_by(F.struct("ym", *FEATURES), "ym").alias("_row"))
    values = F.create_map(*[part for f in FEATURES for part in (F.lit(f), F.col(f).cast("double"))])

    def met(test):
        value = F.col("_values")[test["feature"]]
        return F.when(test["op"] == "<=", value <= test["threshold"]).otherwise(value > test["threshold"])

    months = newest.select("mct_id", "_row.*").withColumn("_values", values)
    joined = made.assigned.join(months, "mct_id").join(made.rules.select("rule_id", "path"), "rule_id")
    return joined.select("mct_id", "k", F.forall("path", met).alias("meets_rule"))
