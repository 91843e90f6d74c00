"""Briefs: requests in, one ranked and JSON-encoded target description per shop, group or cluster."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import fixed_text_sql, percent_label, strength_band
from ..functions.text import masked_tokens, normalize_text, strip
from ..operators.clustering import pivot_profile
from ..operators.groups import attach, group_profiles, place_sums
from ..operators.keyed import dedupe_last
from ..operators.matching import longest_names, name_list
from ..operators.ranking import best_rules, latest_k, newest_runs, top_per_group
from ..schemas import AGE_BANDS, AGE_COLS, AUD_COLS, AUDIENCES, FEATURES, FLAG_COLS
from ..session import cut_lineage
from .features import dominant_age

TOP_MEDIA, TOP_KEYWORDS = 5, 10

# The texts of a brief.
NO_ITEMS, NO_RULE = "없음", "규칙 미확인"
TITLE = "[Cluster %d] %s 중심 고객 타겟 브리프"
HEAD = """당신은 마케팅 카피라이터이자 미디어 플래너입니다.
아래 타겟 브리프에 맞춰 ‘한글’로 톤·메시지·채널/키워드를 제안하세요.
"""
TAIL = """
[작성 원칙(요약)]
- 쉬운 말·불릿 위주, 한 문단 3줄 이내.
- 숫자→뜻→액션(당장 할 일 1~2개).
- ‘높음/보통/낮음’·%로 비교, 과한 단정 금지.

[용어(짧게)]
- Age Mix: 연령 비중(0~1=0~100%).
- NEW 신규, REU 재구매, RES 예약, WORK 직장인, FLOW 유동.
- cancel_high: 취소율 신호, delivery_high: 배달 비중 신호.

[그래프 해석 팁]
- PNG 2장: (1) Age Mix, (2) Audience.
- 막대가 클수록 큼(0~1을 %로 말하기), 최고/최저 먼저 + 시사점 1문장.

[출력]
1) 한 줄 콘셉트
2) 핵심 메시지×3(각 20자 내)
3) 그래프 요약(숫자→뜻→액션, cancel/delivery 포함)
4) 채널 가이드(Top N, KPI/포인트 1~2줄)
5) 키워드 10개
6) KPI 가설 + A/B 2안
7) 대안 타깃 2 & 각색 포인트
8) 리스크·대응(오해 방지 문구)
9) 체크리스트(6~8항목)
"""
CHART_LABELS = {"NEW": "신규", "REU": "단골", "RES": "예약", "WORK": "직장인", "FLOW": "유동"}
CHART_FLOOR = 0.60
EXTRACTS = ("age", "audience")
#: Profiles of a file of extracts.
EXTRACTED = 10_000


@dataclass(frozen=True)
class Sources:
    """The tables a brief draws on; a branch that doesn't need one may leave it out."""

    features: DataFrame
    stg_store: DataFrame
    clusters: DataFrame
    profile: DataFrame | None
    rules: DataFrame | None
    media: DataFrame | None
    keywords: DataFrame | None
    version: str
    #: stored sums per place and cluster (`features.refresh_places`); made of the feature rows if absent
    places: DataFrame | None = None


# --- requests ------------------------------------------------------------------------------------


def parse_requests(requests: DataFrame, stg_store: DataFrame) -> DataFrame:
    """Requests with normalised text, masked shop name, and area and sector found in the text.

    Names are looked up only for requests without a shop id, and only where the request does not
    give the area or sector itself. ``request_id`` identifies a request.
    """
    raw = requests.withColumns(
        {
            "user_input": F.coalesce("user_input", F.lit("")),
            "per_store": F.coalesce("per_store", F.lit(True)) if "per_store" in requests.columns else F.lit(True),
        }
    ).withColumn("text_norm", normalize_text("user_input"))
    wanted = F.col("per_store") & (F.coalesce("mct_id", F.lit("")) == "")
    # equal texts are searched once, under a short id
    texts = raw.filter(wanted).select("text_norm").distinct()
    texts = cut_lineage(texts.withColumn("text_id", F.monotonically_increasing_id()))
    found = longest_names(texts, "text_id", "text_norm", name_list(stg_store))
    found = found.groupBy("text_id").agg(
        F.max(F.when(F.col("kind") == "area", F.col("name"))).alias("found_area"),
        F.max(F.when(F.col("kind") == "sector", F.col("name"))).alias("found_sector"),
    )
    found = texts.join(found, "text_id").drop("text_id")

    def given(column: str) -> Column:
        filled = F.coalesce(F.nullif(F.col(column), F.lit("")), F.col(f"found_{column}"))
        return F.when(wanted, filled).otherwise(F.col(column))

    # only requests that need a lookup meet the names; the others keep what they came with
    none = [F.lit(None).cast("string").alias(c) for c in ("found_area", "found_sector")]
    looked_up = raw.filter(wanted).join(found, "text_norm", "left").select(*raw.columns, "found_area", "found_sector")
    both = looked_up.unionByName(raw.filter(~wanted).select(*raw.columns, *none))
    return both.select(
        *[c for c in raw.columns if c not in ("area", "sector")],
        given("area").alias("area"),
        given("sector").alias("sector"),
        masked_tokens("text_norm").alias("masked_name"),
    )


# --- lookups -------------------------------------------------------------------------------------


def top_items(table: DataFrame, item: str, version: str, n: int) -> DataFrame:
    """Ranked list per age band: at most five rows of at most n items."""
    usable = table.filter((F.col("version") == version) & F.col("age_group").isin(AGE_BANDS))
    ranked = top_per_group(usable, ["version", "age_group"], "affinity", item, n)
    entry = F.struct("rank", F.col(item), F.col("affinity").cast("double").alias("affinity"))
    lists = ranked.groupBy("age_group").agg(F.sort_array(F.collect_list(entry)).alias("_ranked"))
    return lists.select(
        F.col("age_group").alias("dom_age"),
        F.transform("_ranked", lambda e: F.struct(e[item].alias(item), e["affinity"].alias("affinity"))).alias(
            f"rec_{item}s"
        ),
    )


def with_recommendations(rows: DataFrame, sources: Sources, top_media: int, top_kw: int) -> DataFrame:
    """Rows (k, cluster_id, features) with the dominant age, the best rule and the ranked lists.

    The lookups are broadcast: the lists hold one row per age band, the rules one per cluster of
    the newest run of the few k that were tried.
    """
    rules = best_rules(newest_runs(sources.rules)).select("k", "cluster_id", "rule_text")
    channels = top_items(sources.media, "channel", sources.version, top_media)
    keywords = top_items(sources.keywords, "keyword", sources.version, top_kw)
    aged = rows.withColumns({c: F.expr(f"coalesce(cast({c} AS DOUBLE), 0D)") for c in FEATURES})
    aged = aged.withColumn("dom_age", dominant_age())
    joined = (
        aged.join(F.broadcast(rules), ["k", "cluster_id"], "left")
        .join(F.broadcast(channels), "dom_age", "left")
        .join(F.broadcast(keywords), "dom_age", "left")
    )
    for item in ("channel", "keyword"):
        empty = F.array().cast(f"array<struct<{item}:string,affinity:double>>")
        joined = joined.withColumn(f"rec_{item}s", F.coalesce(f"rec_{item}s", empty))
    return joined


# --- texts ---------------------------------------------------------------------------------------


def _numbers(labels: list[str], columns: list[str]) -> Column:
    parts = ", ".join(f"concat('{label}=', {fixed_text_sql(c, 2)})" for label, c in zip(labels, columns))
    return F.expr(f"concat_ws(', ', {parts})")


def _listing(items: str, name: str) -> Column:
    text = f"concat(e.{name}, '(', {fixed_text_sql('e.affinity', 2)}, ')')"
    return F.expr(f"if(size({items}) > 0, array_join(transform({items}, e -> {text}), ', '), '{NO_ITEMS}')")


def brief_title(context: Column) -> Column:
    """Title, after the context if there is one, held to 255 characters."""
    base = F.format_string(TITLE, "cluster_id", "dom_age")
    return F.substring(F.concat_ws(" | ", F.nullif(context, F.lit("")), base), 1, 255)


def brief_text() -> Column:
    """The brief over columns k, cluster_id, dom_age, rule_text, the features, the ranked lists,
    user_input and context_lines."""
    user = F.when(
        F.coalesce("user_input", F.lit("")) != "",
        F.concat(F.lit('\n[사용자 입력]\n- "'), "user_input", F.lit('"')),
    ).otherwise("")
    context = F.when(
        F.size("context_lines") > 0,
        F.concat(F.lit("\n[지역/업종/점포 컨텍스트]\n- "), F.array_join("context_lines", "\n- ")),
    ).otherwise("")
    lines = [
        F.lit(HEAD),
        F.lit("[클러스터]"),
        F.concat(F.lit("- k: "), F.col("k").cast("string")),
        F.concat(F.lit("- Cluster ID: "), F.col("cluster_id").cast("string")),
        F.concat(F.lit("- 지배 연령대: "), "dom_age"),
        F.lit("- 연령 믹스 / 오디언스 / 플래그"),
        F.concat(F.lit("- 연령 믹스: "), _numbers(AGE_BANDS, AGE_COLS)),
        F.concat(F.lit("- 오디언스: "), _numbers(AUDIENCES, AUD_COLS)),
        F.concat(F.lit("- 플래그: "), _numbers(FLAG_COLS, FLAG_COLS)),
        F.lit("\n[대표 규칙]"),
        F.concat(F.lit("- "), F.coalesce(F.nullif("rule_text", F.lit("")), F.lit(NO_RULE))),
        F.concat(F.lit("\n[추천 채널 Top "), F.size("rec_channels").cast("string"), F.lit("]")),
        F.concat(F.lit("- "), _listing("rec_channels", "channel")),
        F.concat(F.lit("\n[추천 키워드 Top "), F.size("rec_keywords").cast("string"), F.lit("]")),
        F.concat(F.lit("- "), _listing("rec_keywords", "keyword"), user, context),
        F.lit(TAIL),
    ]
    return F.concat_ws("\n", *lines)


def _with_texts(rows: DataFrame, context_title: Column) -> DataFrame:
    return rows.withColumn("title", brief_title(context_title)).withColumn("user_prompt", brief_text())


def _context(*lines: tuple[Column, Column]) -> Column:
    """The lines whose condition holds."""
    return F.array_compact(F.array(*[F.when(condition, line) for condition, line in lines]))


def _masked() -> tuple[Column, Column]:
    return F.col("masked_name").isNotNull(), F.concat(F.lit("masked_store_name="), "masked_name")


BRIEF_COLUMNS = [
    "request_id", "mct_id", "ym", "k", "cluster_id", "title", "user_prompt", "rule_text", "dom_age",
    *FEATURES, "rec_channels", "rec_keywords", "context_lines", "user_input",
]


# --- the three kinds of brief ---------------------------------------------------------------------


def shop_rows(features: DataFrame, clusters: DataFrame, ids: DataFrame) -> DataFrame:
    """Newest feature row and cluster of each asked shop; a shop needs both to be found."""
    asked = ids.select("mct_id").distinct()
    columns = ["ym", "sector", "biz_zone", *FEATURES]
    # reduced before the join, so a shop with very many rows arrives as one
    newest = features.groupBy("mct_id").agg(F.max_by(F.struct(*columns), "ym").alias("_row"))
    latest = clusters.groupBy("mct_id").agg(
        F.max_by(F.struct("cluster_id", "k"), F.struct("created_at", "ym")).alias("_cluster")
    )
    found = asked.join(newest, "mct_id").join(latest, "mct_id")
    return found.select("mct_id", "_row.*", "_cluster.*")


def store_briefs(
    parsed: DataFrame, sources: Sources, top_media: int = TOP_MEDIA, top_kw: int = TOP_KEYWORDS
) -> DataFrame:
    """Briefs of the requests that name a known shop."""
    asked = parsed.filter(F.col("per_store") & (F.coalesce("mct_id", F.lit("")) != ""))
    shops = shop_rows(sources.features, sources.clusters, asked)
    rows = asked.select("request_id", "mct_id", "user_input", "masked_name").join(shops, "mct_id")
    zone, sector = (F.coalesce(c, F.lit("None")) for c in ("biz_zone", "sector"))
    always = F.lit(True)
    rows = with_recommendations(rows, sources, top_media, top_kw).withColumn(
        "context_lines",
        _context(
            (always, F.concat(F.lit("biz_zone="), zone)),
            (always, F.concat(F.lit("sector="), sector)),
            (always, F.concat(F.lit("mct_id="), F.col("mct_id"))),
            _masked(),
        ),
    )
    return _with_texts(rows, F.concat_ws("/", zone, sector)).select(BRIEF_COLUMNS)


def group_briefs(
    asked: DataFrame, sources: Sources, run_ts: dt.datetime, top_media: int = TOP_MEDIA, top_kw: int = TOP_KEYWORDS
) -> DataFrame:
    """Briefs of requests for an area and / or sector, also where no shop meets them."""
    places = place_sums(sources.features, sources.clusters) if sources.places is None else sources.places
    # requests that say the same get the same brief, which is written once and then goes to each of them
    alike = ["user_input", "masked_name", "area", "sector"]
    different = cut_lineage(asked.select(alike).distinct())
    rows = attach(different, group_profiles(different, places))
    rows = rows.withColumn("k", latest_k(sources.clusters).scalar()).filter(F.col("k").isNotNull())
    has_area = F.coalesce("area", F.lit("")) != ""
    has_sector = F.coalesce("sector", F.lit("")) != ""
    area, sector = (F.nullif(F.col(c), F.lit("")) for c in ("area", "sector"))
    rows = with_recommendations(rows, sources, top_media, top_kw).withColumns(
        {
            "context_lines": _context(
                (has_area, F.concat(F.lit("area="), F.col("area"))),
                (has_sector, F.concat(F.lit("sector="), F.col("sector"))),
                _masked(),
            ),
            "mct_id": F.concat(
                F.lit("GROUP::"), F.coalesce(area, F.lit("ALL")), F.lit("/"), F.coalesce(sector, F.lit("ALL"))
            ),
            "ym": F.date_format(F.lit(run_ts), "yyyyMM"),
        }
    )
    both = F.concat_ws("/", *[strip(F.coalesce(c, F.lit(""))) for c in ("area", "sector")])
    written = _with_texts(rows, F.regexp_replace(both, "^/+|/+$", ""))
    return attach(asked.select("request_id", *alike), written, alike, "inner").select(BRIEF_COLUMNS)


def cluster_briefs(
    sources: Sources,
    run_ts: dt.datetime,
    k: int | None = None,
    top_media: int = TOP_MEDIA,
    top_kw: int = TOP_KEYWORDS,
) -> DataFrame:
    """One brief per cluster of a k, by default the latest, from the newest stored profile of it."""
    chosen = F.lit(k) if k is not None else latest_k(sources.clusters).scalar()
    stored = sources.profile.filter(F.col("k") == chosen)
    newest = stored.filter(F.col("created_at") == stored.agg(F.max("created_at")).scalar())
    rows = pivot_profile(newest, FEATURES).withColumns(
        {
            "k": chosen.cast("int"),
            "user_input": F.lit(""),
            "request_id": F.lit(None).cast("long"),
            "mct_id": F.concat(F.lit("CLUSTER::"), F.col("cluster_id").cast("string")),
            "ym": F.date_format(F.lit(run_ts), "yyyyMM"),
            "context_lines": F.array().cast("array<string>"),
        }
    )
    rows = with_recommendations(rows, sources, top_media, top_kw)
    return _with_texts(rows, F.lit("")).select(BRIEF_COLUMNS)


def route(parsed: DataFrame, sources: Sources) -> DataFrame:
    """Each request with its branch: a known shop, else an area or sector, else all clusters."""
    known = shop_rows(sources.features, sources.clusters, parsed.filter("per_store")).select(
        "mct_id", F.lit(True).alias("_known")
    )
    named = (F.coalesce("area", F.lit("")) != "") | (F.coalesce("sector", F.lit("")) != "")
    # a request without a shop meets nobody, and such requests would all be one key
    names_shop = F.coalesce("mct_id", F.lit("")) != ""
    met = parsed.filter(names_shop).join(known, "mct_id", "left").select(*parsed.columns, "_known")
    both = met.unionByName(parsed.filter(~names_shop).withColumn("_known", F.lit(None).cast("boolean")))
    return (
        both.withColumn(
            "branch",
            F.when(F.col("per_store") & F.col("_known"), "store")
            .when(F.col("per_store") & named, "group")
            .otherwise("cluster"),
        )
        .select(*parsed.columns, "branch")
    )


def answer(
    requests: DataFrame,
    sources: Sources,
    run_ts: dt.datetime,
    top_media: int = TOP_MEDIA,
    top_kw: int = TOP_KEYWORDS,
    k: int | None = None,
) -> DataFrame:
    """The briefs of a batch of requests; the cluster briefs, of ``k`` or else the latest k, appear
    once if any request falls back to them."""
    routed = cut_lineage(route(parse_requests(requests, sources.stg_store), sources))
    stores = store_briefs(routed.filter(F.col("branch") == "store"), sources, top_media, top_kw)
    groups = group_briefs(routed.filter(F.col("branch") == "group"), sources, run_ts, top_media, top_kw)
    needed = routed.agg(F.bool_or(F.col("branch") == "cluster")).scalar()
    clusters = cluster_briefs(sources, run_ts, k, top_media, top_kw).filter(needed)
    return stores.unionByName(groups).unionByName(clusters)


def brief_json(rows: DataFrame) -> Column:
    """The brief as one JSON document; missing parts stay as null. ``assets`` is in it where there are
    extracts."""
    payload = F.struct(
        "k",
        "cluster_id",
        "title",
        F.lit(None).cast("string").alias("system_prompt"),
        "user_prompt",
        "rule_text",
        "dom_age",
        F.struct(*FEATURES).alias("profile"),
        "rec_channels",
        "rec_keywords",
        "context_lines",
        "user_input",
        *(["assets"] if "assets" in rows.columns else []),
    )
    return F.to_json(payload, {"ignoreNullFields": "false"})


def bundles(briefs: DataFrame, version: str) -> DataFrame:
    """Rows of the stored brief table; of several requests for one target the last counts."""
    last = dedupe_last(briefs.withColumn("version", F.lit(version)), ["mct_id", "ym", "version"], ["request_id"])
    return last.select("mct_id", "ym", "version", brief_json(last).alias("bundle"))


def run(
    tables,
    requests: DataFrame,
    sources: Sources,
    run_ts: dt.datetime,
    k: int | None = None,
    top_media: int = TOP_MEDIA,
    top_kw: int = TOP_KEYWORDS,
    extracts_folder: str | None = None,
) -> DataFrame:
    """Answer requests and store the briefs; returns the brief rows. With a folder the chart extracts of
    all targets are written there, below the run's time, and every bundle names its own."""
    made = answer(requests, sources, run_ts, top_media, top_kw, k)
    if extracts_folder is not None:
        made = cut_lineage(made)
        folder = f"{extracts_folder}/{run_ts:%Y%m%dT%H%M%S}"
        made = made.withColumn("target", F.md5(F.concat_ws("/", "mct_id", "ym")))
        index = write_extracts(made.dropDuplicates(["target"]), ["target"], folder)
        # the file and the target inside it
        places = [F.concat(F.col(part), F.lit("#target="), F.col("target")) for part in EXTRACTS]
        made = made.join(index, "target").withColumn("assets", F.array(*places)).drop("target", *EXTRACTS)
    tables.replace("mat_prompt_bundle", bundles(made, sources.version), ["version"])
    return made


# --- chart data ----------------------------------------------------------------------------------


def _bars(name: str, labels: list[str], columns: list[str]) -> Column:
    """The bars of one profile row, in given order."""
    entries = [
        f"struct(coalesce(cast({c} AS DOUBLE), 0D) AS value, {i} AS place, '{label}' AS {name})"
        for i, (label, c) in enumerate(zip(labels, columns))
    ]
    return F.expr(f"array({', '.join(entries)})")


def _ranked(profiles: DataFrame, keys: list[str], bars: Column, name: str) -> DataFrame:
    """Bars with their rank by falling value. They are ranked inside their row, without a shuffle."""
    falling = F.array_sort(
        F.transform(bars, lambda b: F.struct((-b["value"]).alias("down"), b["place"].alias("place"), b[name].alias(name), b["value"].alias("value")))
    )
    placed = profiles.select(*keys, F.posexplode(falling).alias("_place", "_bar"))
    return placed.select(*keys, f"_bar.{name}", "_bar.value", (F.col("_place") + 1).alias("rank"))


def chart_age(profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Age bars per profile with label and rank."""
    ranked = _ranked(profiles, keys, _bars("bucket", AGE_BANDS, AGE_COLS), "bucket")
    return ranked.withColumn("label", percent_label("value"))


def chart_audience(profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Audience bars of at least 0.60 per profile with display name, band, label and rank."""
    strong = F.filter(_bars("metric", AUDIENCES, AUD_COLS), lambda b: b["value"] >= CHART_FLOOR)
    names = F.create_map(*[F.lit(v) for pair in CHART_LABELS.items() for v in pair])
    return _ranked(profiles, keys, strong, "metric").withColumns(
        {"metric": names[F.col("metric")], "band": strength_band("value"), "label": percent_label("value")}
    )


def profile_extract(profiles: DataFrame, keys: list[str], part: str) -> DataFrame:
    """The two-column extract of each profile: age bars (bucket, value) or audience bars (metric,
    value)."""
    age = part == "age"
    bars = _bars("bucket", AGE_BANDS, AGE_COLS) if age else _bars("metric", AUDIENCES, AUD_COLS)
    return profiles.select(*keys, F.inline(bars)).select(*keys, "bucket" if age else "metric", "value")


def write_extracts(profiles: DataFrame, keys: list[str], folder: str, most: int = EXTRACTED) -> DataFrame:
    """Both extracts as CSV with the profile's keys in front, in a folder that isn't there yet.

    Files hold ranges of keys, about ``most`` profiles each, so their number doesn't grow with the
    targets'. Returns the index, which is stored beside them: keys, and the file of each extract.
    """
    slim = cut_lineage(profiles.select(*keys, *AGE_COLS, *AUD_COLS))
    files = max(1, -(-slim.count() // most))
    ranged = slim.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    for part in EXTRACTS:
        profile_extract(ranged, keys, part).write.option("header", True).csv(f"{folder}/{part}")
    places = [
        slim.sparkSession.read.option("header", True).csv(f"{folder}/{part}")
        .select(*[F.col(k).cast(dict(slim.dtypes)[k]).alias(k) for k in keys],
                F.concat(F.lit(f"{folder}/{part}/"), F.col("_metadata.file_name")).alias(part))
        .distinct()
        for part in EXTRACTS
    ]
    index = places[0].join(places[1], keys)
    index.write.parquet(f"{folder}/index")
    return slim.sparkSession.read.schema(index.schema).parquet(f"{folder}/index")
