"""DuckDB SQL that states each registered query once more, over the same Parquet tables."""

from __future__ import annotations

import re

from ..functions.text import BLANK, NO_RATIO
from ..plans.briefs import HEAD, NO_ITEMS, NO_RULE, TAIL
from ..schemas import AGE_BANDS, AGE_COLS, AUD_COLS, AUDIENCES, FEATURES

_AGE_CODES = ["1020", "30", "40", "50", "60"]
_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_RATIOS = AGE_COLS + AUD_COLS
VERSION = "v1_2025Q3"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _half_up(total: str, n: str, have: int, want: int) -> str:
    """Mean of scaled whole numbers, rounded half up to ``want`` decimals, in exact arithmetic."""
    total = f"({total})::HUGEINT * {10 ** (want - have)}"
    return f"(((2 * {total} + {n}) // (2 * {n}))::DOUBLE / 1e{want})"


def _short_mean(total: str, n: str) -> str:
    """Mean of four-decimal values, rounded to eight decimals and then to four."""
    eight = f"((2 * ({total})::HUGEINT * 10000 + {n}) // (2 * {n}))"
    return f"((({eight} + 5000) // 10000)::DOUBLE / 1e4)"


_units, _of = "sum(round(affinity * 10000)::BIGINT)::HUGEINT", "count(*)"
# mean of four-decimal values, rounded once, ties to even
_even_mean = f"""(({_units} // {_of} + CASE WHEN 2 * ({_units} % {_of}) > {_of}
          OR (2 * ({_units} % {_of}) = {_of} AND ({_units} // {_of}) % 2 = 1) THEN 1 ELSE 0 END)::DOUBLE / 1e4)"""


def _mean(column: str, want: int) -> str:
    """Mean of a column of four-decimal values."""
    return _half_up(f"sum(round({column} * 10000)::BIGINT)", f"count({column})", 4, want)


def _published(condition: str) -> str:
    rate = f"(count(*) FILTER ({condition}))::DOUBLE * 100 / count(*)"
    return f"CASE WHEN count(*) = 1 THEN -999999.9 WHEN min(l_quantity) <= 40 THEN {rate} END"


def _share(column: str) -> str:
    return f"coalesce(least(greatest({column}, 0), 100) / 100.0::DOUBLE, 0)"


def _argmax(columns: list[str], names: list[str]) -> str:
    """First column that is at least as large as every other."""
    cases = " ".join(
        f"WHEN {c} >= greatest({', '.join(o for o in columns if o != c)}) THEN '{n}'"
        for c, n in list(zip(columns, names))[:-1]
    )
    return f"CASE {cases} ELSE '{names[-1]}' END"


_demo_columns = [
    (f"M12_{sex}_{code}_RAT", f"WHERE o_orderpriority = '{word}' AND l_linestatus = '{status}'")
    for sex, status in (("MAL", "F"), ("FME", "O"))
    for code, word in zip(_AGE_CODES, _PRIORITY)
] + [
    ("MCT_UE_CLN_REU_RAT", "WHERE l_discount >= 0.05"),
    ("MCT_UE_CLN_NEW_RAT", "WHERE l_discount < 0.05"),
    ("RC_M1_SHC_RSD_UE_CLN_RAT", "WHERE l_quantity <= 17"),
    ("RC_M1_SHC_WP_UE_CLN_RAT", "WHERE l_quantity > 17 AND l_quantity <= 34"),
    ("RC_M1_SHC_FLP_UE_CLN_RAT", "WHERE l_quantity > 34"),
]
_aud_source = dict(
    zip(
        AUDIENCES,
        [
            "MCT_UE_CLN_NEW_RAT",
            "MCT_UE_CLN_REU_RAT",
            "RC_M1_SHC_RSD_UE_CLN_RAT",
            "RC_M1_SHC_WP_UE_CLN_RAT",
            "RC_M1_SHC_FLP_UE_CLN_RAT",
        ],
    )
)
_by_age = [("10대", 1, 8), ("20대", 9, 16), ("30대", 17, 24), ("40대", 25, 32), ("50대", 33, 40), ("60대 이상", 41, 50)]
_by_age_sql = ", ".join(
    f"floor((count(*) FILTER (WHERE p_size BETWEEN {a} AND {b}))::DOUBLE * 100 / count(*)) AS \"{n}\"" for n, a, b in _by_age
)
_groups = {"10대": "10s", "20대": "10s", "30대": "30s", "40대": "40s", "50대": "50s", "60대 이상": "60p"}


def _cells(source: str, name: str) -> str:
    """Cells of a by-age table; a percent of 1 counts as 1.0, above that as a percent."""
    parts = " UNION ALL ".join(
        f"SELECT {name} AS channel, '{_groups[n]}' AS age_group, {i} AS col_ord,"
        f" CASE WHEN \"{n}\" > 1 THEN \"{n}\" / 100 ELSE \"{n}\" END AS affinity FROM {source}"
        for i, (n, _, _) in enumerate(_by_age)
    )
    return f"SELECT age_group, channel, round(arg_max(affinity, col_ord), 4) AS affinity FROM ({parts}) GROUP BY ALL"


_percent = "CASE WHEN {0} > 1 THEN round({0} / 100.0, 4) WHEN {0} >= 0 THEN {0}::DOUBLE END"
_span_bucket = (
    "CASE WHEN decade + 14.5 < 30 THEN '10s' WHEN decade + 14.5 < 40 THEN '30s' WHEN decade + 14.5 < 50 THEN '40s'"
    " WHEN decade + 14.5 < 60 THEN '50s' ELSE '60p' END"
)
_decade = "floor(p_size / 9) * 10"


def _norm(column: str) -> str:
    blank = BLANK
    stripped = f"regexp_replace(coalesce({column}, ''), '^[{blank}]+|[{blank}]+$', '', 'g')"
    kept = f"regexp_replace({stripped}, '[^\\p{{L}}\\p{{N}}_*{blank}]', ' ', 'g')"
    return f"regexp_replace({kept}, '[{blank}]+', ' ', 'g')"


def _masked(column: str) -> str:
    words = f"list_filter(string_split_regex({column}, '[{BLANK}]+'), lambda w: contains(w, '*'))"
    return f"nullif(array_to_string({words}, ' '), '')"


_numbers2 = lambda labels, columns: " || ', ' || ".join(
    f"'{label}=' || format('{{:.2f}}', coalesce({c}, 0)::DOUBLE)" for label, c in zip(labels, columns)
)

_GIVEN = range(5)  # the clusters of the given labelling


def _tree_level(level: int) -> dict[str, str]:
    """The best split of every node of a level by trying every value, and the rows one level down. A node
    is named by its turns from the root."""
    cells = ", ".join(f"struct_pack(f := {i}, v := {f}::DOUBLE)" for i, f in enumerate(FEATURES))
    left, right = [f"l{c}" for c in _GIVEN], [f"(t{c} - l{c})" for c in _GIVEN]
    gain = " + ".join(f"({' + '.join(f'{x} * {x}' for x in side)})::DOUBLE / ({' + '.join(side)})" for side in (left, right))
    names = " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(FEATURES))
    value = " ".join(f"WHEN {i} THEN {f}::DOUBLE" for i, f in enumerate(FEATURES))
    return {
        f"tree_cells{level}": f"""
        SELECT node, c.f, c.v, {", ".join(f"count(*) FILTER (cluster_id = {c}) AS n{c}" for c in _GIVEN)}
        FROM (SELECT node, cluster_id, unnest([{cells}]) AS c FROM tree_rows{level}) GROUP BY ALL""",
        f"tree_sums{level}": f"""
        SELECT node, f, v, lead(v) OVER (PARTITION BY node, f ORDER BY v) AS above,
          {", ".join(f"(sum(n{c}) OVER (PARTITION BY node, f ORDER BY v))::BIGINT AS l{c}, (sum(n{c}) OVER (PARTITION BY node, f))::BIGINT AS t{c}" for c in _GIVEN)}
        FROM tree_cells{level}""",
        f"tree_splits{level}": f"""
        SELECT node, f, CASE f {names} END AS name, CASE WHEN v + (above - v) / 2 >= above THEN v ELSE v + (above - v) / 2 END AS threshold
        FROM tree_sums{level}
        WHERE above IS NOT NULL AND {" + ".join(left)} >= 50 AND {" + ".join(right)} >= 50
          AND {" + ".join(f"(t{c} > 0)::INT" for c in _GIVEN)} > 1
        QUALIFY row_number() OVER (PARTITION BY node ORDER BY round({gain}, 8) DESC, f, v) = 1""",
        f"tree_rows{level + 1}": f"""
        SELECT * EXCLUDE (node, rule_text, depth, name, threshold, f, goes),
          CASE WHEN goes IS NULL THEN node ELSE node || goes END AS node,
          CASE WHEN goes IS NULL THEN rule_text ELSE rule_text || CASE WHEN depth > 0 THEN ' AND ' ELSE '' END || name
            || CASE goes WHEN 'l' THEN ' <= ' ELSE ' > ' END || format('{{:.3f}}', threshold) END AS rule_text,
          depth + (goes IS NOT NULL)::INT AS depth
        FROM (SELECT r.*, s.f, s.name, s.threshold,
            CASE WHEN s.f IS NOT NULL THEN CASE WHEN CASE s.f {value} END <= s.threshold THEN 'l' ELSE 'r' END END AS goes
          FROM tree_rows{level} r LEFT JOIN tree_splits{level} s USING (node))""",
    }


_CTES: dict[str, str] = {
    "stg_store": """
        SELECT c_custkey::VARCHAR AS ENCODED_MCT,
          r_name || ' ' || n_name || ' ' || CASE c_mktsegment WHEN 'BUILDING' THEN '왕십리로'
            WHEN 'HOUSEHOLD' THEN '무학2길' ELSE '행당동' END || ' ' || c_custkey::VARCHAR AS MCT_BSE_AR,
          c_name AS MCT_NM, CASE WHEN c_acctbal > 8000 THEN 'B' || c_nationkey::VARCHAR END AS MCT_BRD_NUM,
          r_name AS MCT_SIGUNGU_NM, CASE WHEN c_acctbal >= -800 THEN c_mktsegment END AS HPSN_MCT_ZCD_NM,
          CASE WHEN c_acctbal <= 9700 THEN n_name END AS HPSN_MCT_BZN_CD_NM,
          CASE WHEN c_custkey % 14 < 12 THEN strftime(make_date(c_nationkey::BIGINT + 1990, c_custkey % 14 + 1, c_nationkey::BIGINT + 1), '%Y-%m-%d')
            END AS opened, CASE WHEN c_acctbal < 0 AND c_custkey % 2 = 0 THEN '1999-01-31' END AS closed
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "lines": """
        SELECT o_custkey::VARCHAR AS mct_id, strftime(o_orderdate, '%Y%m') AS ym, o_orderpriority, o_orderstatus,
          l_quantity, l_discount, l_returnflag, l_linestatus
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
    "stg_demo": "SELECT mct_id, ym, "
    + ", ".join(f"{_published(cond)} AS {name}" for name, cond in _demo_columns)
    + " FROM lines GROUP BY mct_id, ym",
    "stg_perf": """
        SELECT mct_id, ym, CASE max(o_orderstatus) WHEN 'F' THEN '1_상위1구간' WHEN 'O' THEN 'HIGH'
            ELSE CASE WHEN min(l_discount) < 0.05 THEN '5_하위' END END AS APV_CE_RAT,
          CASE WHEN count(*) = 1 THEN -999999.9
            ELSE (count(*) FILTER (WHERE l_returnflag = 'R'))::DOUBLE / count(*) END AS DLV_SAA_RAT
        FROM lines GROUP BY mct_id, ym HAVING count(*) FILTER (l_returnflag <> 'A') > 0""",
    "age_sums": "SELECT mct_id, ym, "
    + ", ".join(f"{_share(f'M12_MAL_{code}_RAT')} + {_share(f'M12_FME_{code}_RAT')} AS s_{c}" for c, code in zip(AGE_COLS, _AGE_CODES))
    + " FROM stg_demo",
    "age_mix": "SELECT mct_id, ym, "
    + ", ".join(f"round(round(coalesce(s_{c} / nullif(total, 0), 0), 6), 4) AS {c}" for c in AGE_COLS)
    + " FROM (SELECT *, " + " + ".join(f"s_{c}" for c in AGE_COLS) + " AS total FROM age_sums)",
    "audience": "SELECT mct_id, ym, "
    + ", ".join(f"round({_share(source)}, 4) AS {name}" for name, source in _aud_source.items())
    + " FROM stg_demo",
    "flags": """
        SELECT mct_id, ym, CASE WHEN regexp_matches(lower(coalesce(APV_CE_RAT, '')), '상|high') THEN 1 ELSE 0 END AS cancel_high,
          CASE WHEN nullif(DLV_SAA_RAT, -999999.9) > 0.5 THEN 1 ELSE 0 END AS delivery_high
        FROM stg_perf""",
    "features": "SELECT a.mct_id, a.ym, HPSN_MCT_ZCD_NM AS sector, HPSN_MCT_BZN_CD_NM AS biz_zone, MCT_SIGUNGU_NM AS sigungu, "
    + ", ".join(f"a.{c}" for c in AGE_COLS) + ", "
    + ", ".join(f"u.{a} AS {c}" for a, c in zip(AUDIENCES, AUD_COLS))
    + """, f.cancel_high, f.delivery_high
        FROM age_mix a JOIN audience u ON u.mct_id = a.mct_id AND u.ym = a.ym
        LEFT JOIN flags f ON f.mct_id = a.mct_id AND f.ym = a.ym LEFT JOIN stg_store s ON s.ENCODED_MCT = a.mct_id""",
    "age_bucket": f"SELECT mct_id, ym, {_argmax(AGE_COLS, AGE_BANDS)} AS age_bucket FROM age_mix",
    "aud_bucket": f"SELECT mct_id, ym, {_argmax(AUDIENCES, AUDIENCES)} AS aud_bucket FROM audience",
    "assoc": """
        SELECT ag.mct_id, ag.ym, age_bucket, aud_bucket, cancel_high, delivery_high
        FROM age_bucket ag JOIN aud_bucket au ON au.mct_id = ag.mct_id AND au.ym = ag.ym
        LEFT JOIN flags f ON f.mct_id = ag.mct_id AND f.ym = ag.ym""",
    "flag_cells": """
        SELECT cancel_high AS r, delivery_high AS c, count(*) AS n FROM assoc
        WHERE cancel_high IS NOT NULL AND delivery_high IS NOT NULL GROUP BY ALL""",
    "assoc_cells": """
        SELECT 'age_bucket~aud_bucket' AS pair_name, age_bucket AS r, aud_bucket AS c, count(*) AS n FROM assoc GROUP BY ALL
        UNION ALL SELECT 'age_bucket~cancel_high', age_bucket, cancel_high::VARCHAR, count(*)
          FROM assoc WHERE cancel_high IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'aud_bucket~delivery_high', aud_bucket, delivery_high::VARCHAR, count(*)
          FROM assoc WHERE delivery_high IS NOT NULL GROUP BY ALL""",
    "assoc_full": """
        SELECT rows.pair_name, rows.r, cols.c, coalesce(cell.n, 0) AS o, rows.n * cols.n::DOUBLE / total.n AS e, total.n
        FROM (SELECT pair_name, r, sum(n) AS n FROM assoc_cells GROUP BY ALL) rows
        JOIN (SELECT pair_name, c, sum(n) AS n FROM assoc_cells GROUP BY ALL) cols USING (pair_name)
        JOIN (SELECT pair_name, sum(n) AS n FROM assoc_cells GROUP BY ALL) total USING (pair_name)
        LEFT JOIN assoc_cells cell ON cell.pair_name = rows.pair_name AND cell.r = rows.r AND cell.c = cols.c""",
    "assoc_sums": """
        SELECT pair_name, count(DISTINCT r) AS nr, count(DISTINCT c) AS nc, max(n) AS n,
          CASE WHEN count(DISTINCT r) = 2 AND count(DISTINCT c) = 2
            THEN sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e) ELSE sum(pow(o - e, 2) / e) END AS chi2
        FROM assoc_full GROUP BY pair_name""",
    "orders_src": """
        SELECT o_custkey::VARCHAR AS mct_id, strftime(o_orderdate, '%Y%m') AS ym, o_orderpriority AS age_bucket, o_orderkey
        FROM orders""",
    "orders_reduced": """
        SELECT mct_id, ym, arg_max(age_bucket, o_orderkey) AS age_bucket, min(o_orderkey) AS first_key
        FROM orders_src GROUP BY mct_id, ym""",
    "media_by_age": f"SELECT p_brand AS channel, {_by_age_sql} FROM part GROUP BY p_brand",
    "keyword_by_age": f"SELECT p_name, {_by_age_sql} FROM part GROUP BY p_name",
    "video_by_age": f"""
        SELECT CASE WHEN p_type = 'PROMO' THEN p_brand ELSE p_type || ' video' END AS platform, {_by_age_sql}
        FROM part GROUP BY 1""",
    "video_transposed": """
        SELECT age, ages.o AS row_ord, replace(k, '2', '') AS channel, floor(share) AS value, k AS header FROM (
          SELECT CASE WHEN p_size <= 8 THEN '10대' WHEN p_size <= 16 THEN '20대' WHEN p_size <= 24 THEN '30대'
            WHEN p_size <= 32 THEN '40대' WHEN p_size <= 40 THEN '50대' ELSE '60대 이상' END AS age,
            count(*) FILTER (WHERE p_type = 'ECONOMY') * 100.0::DOUBLE / count(*) AS economy,
            count(*) FILTER (WHERE p_type = 'STANDARD') * 100.0::DOUBLE / count(*) AS standard,
            count(*) FILTER (WHERE p_type = 'PROMO') * 100.0::DOUBLE / count(*) AS pro_mo,
            CASE WHEN age NOT IN ('20대', '40대') THEN count(*) FILTER (WHERE p_type = 'SMALL') * 100.0::DOUBLE / count(*) END AS pro_mo2,
            CASE WHEN age IN ('30대', '50대') THEN count(*) FILTER (WHERE p_type = 'LARGE') * 100.0::DOUBLE / count(*) END AS pro_mo22
          FROM part GROUP BY 1) UNPIVOT (share FOR k IN (economy, standard, pro_mo, pro_mo2, pro_mo22))
        JOIN (VALUES ('10대', 1), ('20대', 2), ('30대', 3), ('40대', 4), ('50대', 5), ('60대 이상', 6)) ages(a, o) ON a = age""",
    "media_rows": _cells("media_by_age", "lower(channel)"),
    "video_rows": _cells("video_by_age", "replace(lower(platform), ' ', '_')"),
    "media_merged": """
        SELECT * FROM video_rows UNION ALL
        SELECT m.* FROM media_rows m ANTI JOIN video_rows v ON v.age_group = m.age_group AND v.channel = m.channel""",
    "span_cells": f"""
        SELECT {_span_bucket} AS age_group, channel, affinity FROM (
          SELECT {_decade} AS decade, lower(p_brand) AS channel, {_percent.format('p_size')} AS affinity FROM part
          UNION ALL
          SELECT {_decade}, lower(p_type), {_percent.format('(p_size + 0.5)')} FROM part WHERE NOT starts_with(p_name, 'small'))""",
    "interest_cells": f"""
        SELECT {_span_bucket} AS age_group, keyword, affinity FROM (
          SELECT {_decade} AS decade, replace(p_name, ' ', '') AS keyword, {_percent.format('p_size')} AS affinity FROM part
          UNION ALL SELECT {_decade}, '뷰티_전체', {_percent.format('p_size')} FROM part)""",
    "interest_rows": f"""
        SELECT age_group, keyword, {_even_mean} AS affinity
        FROM interest_cells GROUP BY age_group, keyword""",
    "media_ranked": f"""
        SELECT '{VERSION}' AS version, *, row_number() OVER (PARTITION BY age_group ORDER BY affinity DESC, channel) AS rank
        FROM media_merged QUALIFY rank <= 5""",
    "keywords_ranked": f"""
        SELECT '{VERSION}' AS version, age_group, keyword, affinity,
          row_number() OVER (PARTITION BY age_group ORDER BY affinity DESC, keyword) AS rank
        FROM interest_rows QUALIFY rank <= 10""",
    "filled": "SELECT mct_id, ym, sector, biz_zone, sigungu, "
    + ", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in FEATURES)
    + " FROM features",
    "newest": "SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY mct_id ORDER BY ym DESC) = 1",
    "clusters": f"""
        SELECT mct_id, ym, CASE {_argmax(AGE_COLS, AGE_BANDS)}
          WHEN '10s' THEN 0 WHEN '30s' THEN 1 WHEN '40s' THEN 2 WHEN '50s' THEN 3 ELSE 4 END AS cluster_id
        FROM newest""",
    "labelled": "SELECT f.*, c.cluster_id FROM clusters c JOIN filled f ON f.mct_id = c.mct_id",
    "profile": "\n UNION ALL ".join(
        f"SELECT cluster_id, '{f}' AS feature, {_mean(f, 12)} AS mean, round(stddev_pop({f}), 6) AS std, count(*) AS n"
        " FROM labelled GROUP BY cluster_id"
        for f in FEATURES
    ),
    "profile_now": "SELECT cluster_id, "
    + ", ".join(f"{_mean(f, 12)} AS {f}" for f in FEATURES)
    + " FROM labelled GROUP BY cluster_id",
    "leaf_counts": f"""
        SELECT {_argmax(AUD_COLS, AUDIENCES)} || ' ' || cancel_high::INT::VARCHAR AS leaf, cluster_id, count(*) AS n
        FROM labelled GROUP BY ALL""",
    "given_rules": """
        SELECT dense_rank() OVER (ORDER BY leaf) AS rule_id, 5 AS k,
          CASE WHEN starts_with(leaf, 'NEW') THEN 1 ELSE 2 END AS depth, cluster_id, leaf AS rule_text, support,
          round(n::DOUBLE / support, 2) AS rule_precision
        FROM (SELECT *, sum(n) OVER (PARTITION BY leaf) AS support FROM leaf_counts)
        QUALIFY row_number() OVER (PARTITION BY leaf ORDER BY n DESC, cluster_id) = 1""",
    "best_rules": """
        SELECT * FROM given_rules QUALIFY row_number() OVER
          (PARTITION BY k, cluster_id ORDER BY rule_precision DESC, support DESC, depth, rule_id) = 1""",
    "rule_rows": """
        SELECT *, CASE WHEN aud_new <= 0.5 THEN CASE WHEN age_40s <= 0.25 THEN 1 ELSE 2 END
          ELSE CASE WHEN cancel_high <= 0.5 THEN 3 ELSE 4 END END AS rule_id
        FROM labelled""",
    "rule_counts": "SELECT rule_id, cluster_id, count(*) AS n FROM rule_rows GROUP BY ALL",
    "rule_stats": """
        SELECT rule_id, cluster_id, support, n::DOUBLE / support AS rule_precision
        FROM (SELECT *, sum(n) OVER (PARTITION BY rule_id) AS support FROM rule_counts)
        QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY n DESC, cluster_id) = 1""",
    "tree_rows0": "SELECT *, '' AS node, '' AS rule_text, 0 AS depth FROM labelled",
    **_tree_level(0),
    **_tree_level(1),
    **_tree_level(2),
    "tree_counts": "SELECT node, rule_text, depth, cluster_id, count(*) AS n FROM tree_rows3 WHERE depth > 0 GROUP BY ALL",
    "tree_rules": """
        SELECT dense_rank() OVER (ORDER BY node) AS rule_id, * FROM (SELECT *, sum(n) OVER (PARTITION BY node) AS support FROM tree_counts
          QUALIFY row_number() OVER (PARTITION BY node ORDER BY n DESC, cluster_id) = 1)""",
    "points": "SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings",
    "centers": """
        SELECT label AS cluster_id, list(m ORDER BY i) AS center FROM (
          SELECT label, i, avg(x[i]) AS m FROM points, generate_series(1, len(x)) AS t(i) GROUP BY label, i) GROUP BY label""",
    "near": """
        SELECT vec_id, cluster_id, list_sum(list_transform(list_zip(x, center), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM points, centers QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster_id) = 1""",
    "pair_means": """
        SELECT a.vec_id, a.label, b.label AS other,
          sum({distance}) / (count(*) - CASE WHEN a.label = b.label THEN 1 ELSE 0 END) AS d
        FROM points a, points b GROUP BY a.vec_id, a.label, b.label""",
    "silhouettes": """
        SELECT vec_id, (b - a) / greatest(a, b) AS s FROM (
          SELECT vec_id, max(d) FILTER (WHERE label = other) AS a, min(d) FILTER (WHERE label <> other) AS b
          FROM pair_means GROUP BY vec_id)""",
    "vocab": """
        SELECT DISTINCT HPSN_MCT_ZCD_NM AS sector, NULL::VARCHAR AS area FROM stg_store WHERE HPSN_MCT_ZCD_NM IS NOT NULL
        UNION ALL SELECT DISTINCT NULL, MCT_SIGUNGU_NM FROM stg_store WHERE MCT_SIGUNGU_NM IS NOT NULL
        UNION ALL SELECT DISTINCT NULL, HPSN_MCT_BZN_CD_NM FROM stg_store WHERE HPSN_MCT_BZN_CD_NM IS NOT NULL""",
    "names": """
        SELECT DISTINCT CASE WHEN sector IS NOT NULL THEN 'sector' ELSE 'area' END AS kind, coalesce(sector, area) AS name
        FROM vocab""",
    "requests": """
        SELECT c_custkey AS request_id, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE')
            THEN '  ' || n_name || ' ' || c_mktsegment || '!! 스**커피 분석 '
            WHEN c_mktsegment = 'MACHINERY' THEN n_name || ' 가게?' ELSE 'hello *shop*' END AS user_input,
          CASE WHEN c_acctbal > 9500 THEN 'unknown' WHEN c_acctbal > 7000 THEN c_custkey::VARCHAR END AS mct_id
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "found": """
        SELECT request_id, kind, name FROM requests JOIN names ON contains(user_input, name)
        QUALIFY row_number() OVER (PARTITION BY request_id, kind ORDER BY length(name) DESC, name) = 1""",
    "parsed": f"""
        SELECT r.request_id, user_input, mct_id, {_norm('user_input')} AS text_norm,
          CASE WHEN mct_id IS NULL THEN a.name END AS area, CASE WHEN mct_id IS NULL THEN s.name END AS sector,
          {_masked(_norm('user_input'))} AS masked_name
        FROM requests r LEFT JOIN found a ON a.request_id = r.request_id AND a.kind = 'area'
        LEFT JOIN found s ON s.request_id = r.request_id AND s.kind = 'sector'""",
    "asked": "SELECT * FROM parsed WHERE area IS NOT NULL OR sector IS NOT NULL",
    "group_rows": """
        SELECT p.area, p.sector AS asked_sector, f.*, c.cluster_id
        FROM (SELECT DISTINCT area, sector FROM asked) p JOIN features f
          ON (p.area IS NULL OR biz_zone ILIKE '%' || p.area || '%' OR sigungu ILIKE '%' || p.area || '%')
          AND (p.sector IS NULL OR f.sector ILIKE '%' || p.sector || '%')
        LEFT JOIN clusters c ON c.mct_id = f.mct_id""",
    "group_means": "SELECT p.area, p.sector, count(g.mct_id) AS n, "
    + ", ".join(f"CASE WHEN count(g.{f}) > 0 THEN {_half_up(f'sum(round(g.{f} * 10000)::BIGINT)', f'greatest(count(g.{f}), 1)', 4, 8)} END AS {f}" for f in FEATURES)
    + """ FROM (SELECT DISTINCT area, sector FROM asked) p LEFT JOIN group_rows g
          ON g.area IS NOT DISTINCT FROM p.area AND g.asked_sector IS NOT DISTINCT FROM p.sector
        GROUP BY p.area, p.sector""",
    "group_cluster": """
        SELECT area, asked_sector, cluster_id, count(*) AS n FROM group_rows WHERE cluster_id IS NOT NULL
        GROUP BY area, asked_sector, cluster_id
        QUALIFY row_number() OVER (PARTITION BY area, asked_sector ORDER BY n DESC, cluster_id) = 1""",
    "media_lists": """
        SELECT age_group, count(*) AS n, string_agg(channel || '(' || format('{:.2f}', affinity) || ')', ', ' ORDER BY rank) AS line,
          string_agg(channel || ':' || format('{:.4f}', affinity), ',' ORDER BY rank) AS listing
        FROM media_ranked GROUP BY age_group""",
    "keyword_lists": """
        SELECT age_group, count(*) AS n, string_agg(keyword || '(' || format('{:.2f}', affinity) || ')', ', ' ORDER BY rank) AS line,
          string_agg(keyword || ':' || format('{:.4f}', affinity), ',' ORDER BY rank) AS listing
        FROM keywords_ranked GROUP BY age_group""",
    "brief_store": "SELECT p.request_id, p.user_input, p.masked_name, w.mct_id, w.ym, 5 AS k, c.cluster_id, "
    + ", ".join(f"coalesce(w.{f}, 0)::DOUBLE AS {f}" for f in FEATURES)
    + """, coalesce(biz_zone, 'None') || '/' || coalesce(sector, 'None') AS ctx_title,
          'biz_zone=' || coalesce(biz_zone, 'None') || '|sector=' || coalesce(sector, 'None') || '|mct_id=' || w.mct_id
            || coalesce('|masked_store_name=' || p.masked_name, '') AS context
        FROM (SELECT request_id, user_input, mct_id, masked_name FROM parsed) p
        JOIN newest w ON w.mct_id = p.mct_id JOIN clusters c ON c.mct_id = p.mct_id""",
    "brief_group": "SELECT r.request_id, r.user_input, r.masked_name, 'GROUP::' || coalesce(r.area, 'ALL') || '/'"
    " || coalesce(r.sector, 'ALL') AS mct_id, '202510' AS ym, 5 AS k, coalesce(c.cluster_id, 0) AS cluster_id, "
    + ", ".join(f"coalesce(g.{f}, 0)::DOUBLE AS {f}" for f in FEATURES)
    + """, trim(coalesce(r.area, '') || '/' || coalesce(r.sector, ''), '/') AS ctx_title,
          array_to_string(list_filter(['area=' || r.area, 'sector=' || r.sector, 'masked_store_name=' || r.masked_name],
            lambda v: v IS NOT NULL), '|') AS context
        FROM asked r JOIN group_means g ON g.area IS NOT DISTINCT FROM r.area AND g.sector IS NOT DISTINCT FROM r.sector
        LEFT JOIN group_cluster c ON c.area IS NOT DISTINCT FROM r.area AND c.asked_sector IS NOT DISTINCT FROM r.sector""",
    "brief_cluster": "SELECT NULL::BIGINT AS request_id, '' AS user_input, NULL::VARCHAR AS masked_name,"
    " 'CLUSTER::' || cluster_id::VARCHAR AS mct_id, '202510' AS ym, 5 AS k, cluster_id, "
    + ", ".join(FEATURES)
    + ", '' AS ctx_title, '' AS context FROM profile_now",
}


def _brief(source: str, extra: str = "") -> str:
    """Title and text over one of the brief row sources."""
    title = (
        "left(CASE WHEN ctx_title <> '' THEN ctx_title || ' | ' ELSE '' END || '[Cluster ' || b.cluster_id::VARCHAR"
        " || '] ' || dom_age || ' 중심 고객 타겟 브리프', 255)"
    )
    parts = [
        _text(HEAD + "\n[클러스터]\n- k: "),
        "b.k::VARCHAR",
        _text("\n- Cluster ID: "),
        "b.cluster_id::VARCHAR",
        _text("\n- 지배 연령대: "),
        "dom_age",
        _text("\n- 연령 믹스 / 오디언스 / 플래그\n- 연령 믹스: "),
        _numbers2(AGE_BANDS, AGE_COLS),
        _text("\n- 오디언스: "),
        _numbers2(AUDIENCES, AUD_COLS),
        _text("\n- 플래그: "),
        _numbers2(["cancel_high", "delivery_high"], ["cancel_high", "delivery_high"]),
        _text("\n\n[대표 규칙]\n- "),
        f"coalesce(r.rule_text, '{NO_RULE}')",
        _text("\n\n[추천 채널 Top "),
        "coalesce(m.n, 0)::VARCHAR",
        _text("]\n- "),
        f"coalesce(m.line, '{NO_ITEMS}')",
        _text("\n\n[추천 키워드 Top "),
        "coalesce(w.n, 0)::VARCHAR",
        _text("]\n- "),
        f"coalesce(w.line, '{NO_ITEMS}')",
        "CASE WHEN user_input <> '' THEN " + _text('\n[사용자 입력]\n- "') + " || user_input || '\"' ELSE '' END",
        "CASE WHEN context <> '' THEN " + _text("\n[지역/업종/점포 컨텍스트]\n- ")
        + " || replace(context, '|', " + _text("\n- ") + ") ELSE '' END",
        _text("\n" + TAIL),
    ]
    return f"""
        SELECT b.request_id, b.mct_id, b.ym, b.k::BIGINT AS k, b.cluster_id::BIGINT AS cluster_id, {title} AS title,
          {' || '.join(parts)} AS user_prompt, r.rule_text, dom_age, coalesce(m.listing, '') AS channels,
          coalesce(w.listing, '') AS keywords, context{extra}
        FROM (SELECT *, {_argmax(AGE_COLS, AGE_BANDS)} AS dom_age FROM {source}) b
        LEFT JOIN best_rules r ON r.k = b.k AND r.cluster_id = b.cluster_id
        LEFT JOIN media_lists m ON m.age_group = dom_age LEFT JOIN keyword_lists w ON w.age_group = dom_age"""


def _with(body: str, **changes: str) -> str:
    """The body after the CTEs it needs, in order of definition."""
    ctes = {**_CTES, **changes}
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(ctes[name])

    visit(body)
    chosen = [f"{name} AS ({ctes[name]})" for name in ctes if name in needed]
    return ("WITH " + ",\n".join(chosen) + "\n" if chosen else "") + body


_list_distance = "list_distance(a.x, b.x)"
_list_squared = "pow(list_distance(a.x, b.x), 2)"
_crosstab = """
    SELECT r.row_cat, c.col_cat, count(a.mct_id)::BIGINT AS n
    FROM (SELECT DISTINCT {0}::VARCHAR AS row_cat FROM assoc WHERE {0} IS NOT NULL AND {1} IS NOT NULL) r
    CROSS JOIN (SELECT DISTINCT {1}::VARCHAR AS col_cat FROM assoc WHERE {0} IS NOT NULL AND {1} IS NOT NULL) c
    LEFT JOIN assoc a ON a.{0}::VARCHAR = r.row_cat AND a.{1}::VARCHAR = c.col_cat GROUP BY ALL"""
_feature_list = ", ".join(f"{c}::DOUBLE AS {c}" if c in _RATIOS else f"{c}::BIGINT AS {c}" for c in FEATURES)
_bars = "\n UNION ALL ".join
_ratio_value = (
    "CASE WHEN list_contains([" + ", ".join(_text(w) for w in NO_RATIO) + "], bare) THEN NULL"
    " WHEN NOT regexp_matches(number, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN NULL"
    " ELSE try_cast(number AS DOUBLE) END"
)
_audience_names = {"NEW": "신규", "REU": "단골", "RES": "예약", "WORK": "직장인", "FLOW": "유동"}

_profile = " || ',' || ".join(f"format('{{:.12f}}', coalesce(b.{c}, 0)::DOUBLE)" for c in FEATURES)
_extra = f", {_profile} AS profile, b.user_input"
_bundles = f"""
        SELECT *, '{VERSION}' AS version FROM (
          {_brief("brief_store", _extra)} UNION ALL {_brief("brief_group", _extra)} UNION ALL {_brief("brief_cluster", _extra)}
          WHERE EXISTS (SELECT 1 FROM parsed p ANTI JOIN newest n ON n.mct_id = p.mct_id
            WHERE p.area IS NULL AND p.sector IS NULL))
        QUALIFY row_number() OVER (PARTITION BY mct_id, ym ORDER BY request_id DESC) = 1"""

ORACLE: dict[str, str] = {
    "dim_store": """
        SELECT ENCODED_MCT AS mct_id, MCT_NM AS name, HPSN_MCT_ZCD_NM AS sector, HPSN_MCT_BZN_CD_NM AS biz_zone,
          MCT_SIGUNGU_NM AS sigungu, MCT_BSE_AR AS addr,
          nullif(regexp_extract(MCT_BSE_AR, '([가-힣A-Za-z0-9\\- ]+(로|길))'), '') AS road_name, MCT_BRD_NUM AS brand_code,
          opened AS open_dt, closed AS close_dt
        FROM stg_store""",
    "road_names": """
        SELECT ENCODED_MCT, nullif(regexp_extract(MCT_BSE_AR, '([가-힣A-Za-z0-9\\- ]+(로|길))'), '') AS road_name
        FROM stg_store""",
    "age_mix": "SELECT * FROM age_mix",
    "audience_type": "SELECT * FROM audience",
    "perf_flags": "SELECT mct_id, ym, cancel_high::BIGINT AS cancel_high, delivery_high::BIGINT AS delivery_high FROM flags",
    "region_age_avg": "SELECT HPSN_MCT_ZCD_NM AS sector, HPSN_MCT_BZN_CD_NM AS biz_zone, ym, "
    + ", ".join(f"{_short_mean(f'sum(round({c} * 10000)::BIGINT)', f'count({c})')} AS {c}" for c in AGE_COLS)
    + """ FROM age_mix JOIN stg_store ON ENCODED_MCT = mct_id
        WHERE HPSN_MCT_ZCD_NM IS NOT NULL AND HPSN_MCT_BZN_CD_NM IS NOT NULL GROUP BY ALL""",
    "store_features": f"SELECT mct_id, ym, sector, biz_zone, sigungu, {_feature_list} FROM features",
    "store_features_latest": f"SELECT mct_id, ym, sector, biz_zone, sigungu, {_feature_list} FROM newest",
    "age_bucket": "SELECT * FROM age_bucket",
    "aud_bucket": "SELECT * FROM aud_bucket",
    "assoc_dataset": """
        SELECT mct_id, ym, age_bucket, aud_bucket, cancel_high::BIGINT AS cancel_high, delivery_high::BIGINT AS delivery_high
        FROM assoc""",
    "crosstab_age_aud": _crosstab.format("age_bucket", "aud_bucket"),
    "crosstab_age_cancel": _crosstab.format("age_bucket", "cancel_high"),
    "crosstab_aud_delivery": _crosstab.format("aud_bucket", "delivery_high"),
    # the tail has a closed form for an even number of degrees of freedom, which all three tests have
    "assoc_tests": """
        SELECT pair_name, round(chi2, 8) AS chi2, ((nr - 1) * (nc - 1))::BIGINT AS dof,
          round(exp(-chi2 / 2) * list_sum(list_transform(range(0, (nr - 1) * (nc - 1) // 2),
            lambda i: pow(chi2 / 2, i) / factorial(i::INTEGER)::DOUBLE)), 8) AS p_value,
          round(sqrt(chi2 / n / (least(nr, nc) - 1)), 8) AS cramers_v, n::BIGINT AS n
        FROM assoc_sums""",
    # the tail for one degree of freedom is 1 - erf(sqrt(chi2 / 2)), by a series without alternating signs
    "assoc_two_by_two": """
        SELECT 'cancel_high~delivery_high' AS pair_name, round(chi2, 8) AS chi2, 1::BIGINT AS dof,
          round(1 - list_sum(list_transform(range(0, 400),
            lambda i: CASE WHEN chi2 > 0 THEN exp(-chi2 / 2 + (i + 0.5) * ln(chi2 / 2) - lgamma(i + 1.5)) ELSE 0 END)), 8) + 0 AS p_value,
          round(sqrt(chi2 / n), 8) AS cramers_v, n::BIGINT AS n
        FROM (SELECT sum(pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e) AS chi2, sum(o) AS n FROM (
          SELECT n AS o, (sum(n) OVER (PARTITION BY r)) * (sum(n) OVER (PARTITION BY c))::DOUBLE / sum(n) OVER () AS e FROM flag_cells))""",
    "upsert_rows": """
        SELECT coalesce(t.mct_id, s.mct_id) AS mct_id, coalesce(t.ym, s.ym) AS ym,
          CASE WHEN s.mct_id IS NOT NULL THEN s.age_bucket ELSE t.age_bucket END AS age_bucket,
          CASE WHEN t.mct_id IS NOT NULL THEN 'first' ELSE 'order ' || first_key::VARCHAR END AS loaded
        FROM age_bucket t FULL JOIN orders_reduced s ON s.mct_id = t.mct_id AND s.ym = t.ym""",
    "replace_rows": """
        SELECT mct_id, ym, age_bucket, NULL::VARCHAR AS loaded FROM orders_reduced
        UNION ALL SELECT t.mct_id, t.ym, t.age_bucket, 'first' FROM age_bucket t
        ANTI JOIN orders_reduced s ON s.mct_id = t.mct_id AND s.ym = t.ym""",
    "dedupe_last": """
        SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "backfill_update": """
        SELECT ENCODED_MCT, HPSN_MCT_ZCD_NM,
          CASE WHEN HPSN_MCT_ZCD_NM = 'BUILDING' AND MCT_BRD_NUM IS NULL THEN 'NONE' ELSE MCT_BRD_NUM END AS MCT_BRD_NUM
        FROM stg_store""",
    "csv_null_tokens": """
        SELECT c_custkey::VARCHAR AS key, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
          THEN c_mktsegment || ', "' || c_name || '"' END AS word, '가게' AS "한글"
        FROM customer""",
    "typed_cast": """
        SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
          CASE WHEN o_orderstatus <> 'F' THEN round(o_totalprice, 2) END AS amount,
          CASE WHEN o_totalprice < 99.99995 THEN round(o_totalprice, 4) END AS ratio, NULL::VARCHAR AS absent
        FROM orders""",
    "typed_cast_lost": """
        SELECT unnest(['id', 'day', 'amount', 'ratio']) AS column, unnest([0,
          count(*) FILTER (o_orderdate IS NOT NULL AND (o_orderstatus = 'P' OR o_orderpriority = '5-LOW')),
          count(*) FILTER (o_orderstatus = 'F'), count(*) FILTER (o_totalprice >= 99.99995)]) AS n FROM orders""",
    "charset_mixed": """
        SELECT p_partkey AS key, '상품 "' || p_name || '", ' || p_type AS name FROM part""",
    "map_age": """
        SELECT p_partkey, CASE WHEN regexp_matches(s, '10대|10 대|10s|teens|youth|20대|20 대|20s|1020|10-20|10~20')
            OR m IN ('10', '20') THEN '10s' WHEN m IN ('30', '40', '50') THEN m || 's'
            WHEN m = '60' OR regexp_matches(s, '이상|고령') THEN '60p' END AS age_group
        FROM (SELECT *, regexp_extract(s, '(10|20|30|40|50|60)') AS m FROM (
          SELECT p_partkey, lower(trim(CASE p_type WHEN 'PROMO' THEN ' ' || p_size::VARCHAR || '대 '
            WHEN 'SMALL' THEN p_size::VARCHAR || '0대' WHEN 'LARGE' THEN 'TEENS ' || p_name WHEN 'MEDIUM' THEN p_name || ' 이상'
            WHEN 'ECONOMY' THEN 'age ' || p_size::VARCHAR || '-' || (p_size + 9)::VARCHAR ELSE p_name END)) AS s
          FROM part))""",
    "as_ratio": f"""
        SELECT l_orderkey, l_partkey, l_linenumber::BIGINT AS l_linenumber,
          CASE WHEN v > 1 THEN CASE WHEN v / 100 <= 1 THEN format('{{:.4f}}', v / 100)::DOUBLE END
            WHEN v >= 0 THEN format('{{:.4f}}', v)::DOUBLE END AS ratio
        FROM (SELECT *, {_ratio_value} AS v FROM (SELECT *, trim(regexp_replace(bare, '%$', '')) AS number FROM (
          SELECT l_orderkey, l_partkey, l_linenumber, replace(trim(cell), ',', '') AS bare FROM (
            SELECT *, CASE WHEN l_returnflag = 'A' THEN ' ' || q || ' %'
              WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN '0.' || q WHEN l_returnflag = 'R' THEN '1,' || q
              WHEN l_linestatus = 'O' THEN q || '.5%' WHEN l_quantity <= 10 THEN '-' WHEN l_quantity <= 20 THEN '-999999.9'
              WHEN l_quantity <= 30 THEN q || 'e-3' WHEN l_quantity <= 40 THEN q || 'd' ELSE 'NaN' END AS cell
            FROM (SELECT *, l_quantity::INT::VARCHAR AS q FROM lineitem)))))""",
    # a low end of 10n0 (digits parted by _) with a high end of 10n + 9 has its middle above 60
    "age_span_bucket": f"SELECT p_partkey AS row_ord, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN CASE WHEN (10 * (decade + 10) + decade + 19) / 2 < 60 THEN '50s' ELSE '60p' END ELSE {_span_bucket} END AS age_group FROM (SELECT p_partkey, {_decade} AS decade, p_type FROM part)",
    "normalized_texts": f"""
        SELECT id, {_norm('text')} AS text_norm FROM (
          SELECT 'd' || doc_id::VARCHAR AS id, text FROM documents
          UNION ALL SELECT 'c' || conv_id::VARCHAR || '/' || turn::VARCHAR, text FROM conversations
          UNION ALL SELECT 'r' || request_id::VARCHAR, user_input FROM requests)""",
    "masked_words": f"""
        SELECT id, {_masked(_norm('text'))} AS masked FROM (
          SELECT 'd' || doc_id::VARCHAR AS id, text FROM documents
          UNION ALL SELECT 'r' || request_id::VARCHAR, user_input FROM requests)""",
    "affinity_by_age": "SELECT * FROM media_rows",
    "affinity_by_span": f"""
        SELECT age_group, channel, {_even_mean} AS affinity
        FROM span_cells GROUP BY age_group, channel""",
    "affinity_name_pairs": "SELECT age_group, keyword, affinity FROM interest_rows",
    "affinity_transpose": f"""
        SELECT CASE age {' '.join(f"WHEN '{a}' THEN '{g}'" for a, g in _groups.items())} END AS age_group, channel,
          round(arg_max(CASE WHEN value > 1 THEN value / 100 ELSE value END, (length(header), row_ord)), 4) AS affinity
        FROM video_transposed GROUP BY ALL""",
    "affinity_keyword_by_age": _cells("keyword_by_age", "replace(p_name, ' ', '')").replace("channel", "keyword"),
    "affinity_stored": f"""
        SELECT '{VERSION}' AS version, 'channel' AS kind, age_group, channel AS item, affinity FROM media_merged
        UNION ALL SELECT '{VERSION}', 'keyword', age_group, keyword, affinity FROM interest_rows""",
    "affinity_merge": f"SELECT '{VERSION}' AS version, * FROM media_merged",
    "top_media": "SELECT version, age_group, channel, affinity, rank::BIGINT AS rank FROM media_ranked",
    "top_keywords": "SELECT version, age_group, keyword, affinity, rank::BIGINT AS rank FROM keywords_ranked",
    "standardize": "SELECT mct_id, ym, "
    + ", ".join(
        f"round(({f} - avg({f}) OVER ()) / CASE WHEN min({f}) OVER () = max({f}) OVER () THEN 1 ELSE stddev_pop({f}) OVER () END, 6) + 0 AS {f}"
        for f in FEATURES
    )
    + " FROM filled",
    "nearest_center": "SELECT vec_id, cluster_id::BIGINT AS cluster_id, round(d, 6) AS squared_distance FROM near",
    "inertia_fixed": "SELECT round(sum(d), 6) AS inertia FROM near",
    "cluster_profile": "SELECT cluster_id::BIGINT AS cluster_id, feature, mean, std, n::BIGINT AS n FROM profile",
    "profile_pivot": f"SELECT cluster_id::BIGINT AS cluster_id, {', '.join(FEATURES)} FROM profile_now",
    "latest_k": "SELECT left(o_orderpriority, 1)::BIGINT AS k FROM orders ORDER BY o_orderdate DESC, 1 DESC LIMIT 1",
    "stratified_counts": """
        SELECT cluster_id::BIGINT AS cluster_id, (n - t)::BIGINT AS n_train, t::BIGINT AS n_test FROM (
          SELECT *, whole + CASE WHEN row_number() OVER (ORDER BY exact - whole DESC, cluster_id) <= total - sum(whole) OVER ()
            THEN 1 ELSE 0 END AS t
          FROM (SELECT *, floor(exact)::BIGINT AS whole FROM (
            SELECT cluster_id, n, ceil(sum(n) OVER () * 0.2)::BIGINT AS total,
              n * ceil(sum(n) OVER () * 0.2) / (sum(n) OVER ())::DOUBLE AS exact
            FROM (SELECT cluster_id, count(*) AS n FROM labelled GROUP BY cluster_id))))""",
    "stored_rules_newest": """
        SELECT rule_id::BIGINT AS rule_id, k::BIGINT AS k, depth::BIGINT AS depth, cluster_id::BIGINT AS cluster_id, rule_text,
          support::BIGINT AS support, rule_precision FROM given_rules""",
    "stored_profile": " UNION ALL ".join(
        f"SELECT 4::BIGINT AS k, '{f}' AS feature, count(*)::BIGINT AS n, round(avg({f}), 6) AS mean FROM filled" for f in FEATURES
    ),
    "rule_membership": "SELECT mct_id, ym, rule_id::BIGINT AS rule_id FROM rule_rows",
    "rule_stats": """
        SELECT rule_id::BIGINT AS rule_id, cluster_id::BIGINT AS cluster_id, support::BIGINT AS support, rule_precision
        FROM rule_stats""",
    "best_rule": """
        SELECT rule_id, k::BIGINT AS k, depth::BIGINT AS depth, cluster_id::BIGINT AS cluster_id, rule_text,
          support::BIGINT AS support, rule_precision FROM best_rules""",
    "accuracy": """
        SELECT count(*) FILTER (WHERE r.cluster_id = s.cluster_id)::DOUBLE / count(*) AS accuracy
        FROM rule_rows r JOIN rule_stats s USING (rule_id)""",
    "tree_rules_given": """
        SELECT rule_id::BIGINT AS rule_id, depth::BIGINT AS depth, cluster_id::BIGINT AS cluster_id, rule_text,
          support::BIGINT AS support, n::DOUBLE / support AS rule_precision,
          (SELECT sum(n) / sum(support) FROM tree_rules) AS train_acc
        FROM tree_rules""",
    "tree_assign_given": """
        SELECT mct_id, ym, rule_id::BIGINT AS rule_id, t.cluster_id::BIGINT AS rule_cluster
        FROM tree_rows3 r JOIN tree_rules t USING (node)""",
    "vocab": "SELECT * FROM vocab",
    "longest_match": "SELECT request_id, kind, name FROM found",
    "names_in_documents": """
        SELECT doc_id, kind, name FROM documents JOIN (
          SELECT DISTINCT 'word' AS kind, lower(string_split(text, ' ')[1]) AS name FROM benchmark) ON contains(text, name)
        WHERE name <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, kind ORDER BY length(name) DESC, name) = 1""",
    "like_filter": """
        SELECT param, value FROM (SELECT DISTINCT 'nat%' || substr(n_name, 8) AS param FROM nation)
        JOIN (SELECT DISTINCT 'Nation ' || p_name || ' ' || p_size::VARCHAR AS value FROM part)
          ON value ILIKE '%' || param || '%'""",
    "parsed_requests": "SELECT request_id, mct_id, text_norm, area, sector, masked_name FROM parsed",
    "group_mean": f"SELECT area, sector, n::BIGINT AS n, {', '.join(FEATURES)} FROM group_means",
    "representative_cluster": """
        SELECT r.request_id, r.area, r.sector, coalesce(c.cluster_id, 0)::BIGINT AS cluster_id
        FROM asked r LEFT JOIN group_cluster c
          ON c.area IS NOT DISTINCT FROM r.area AND c.asked_sector IS NOT DISTINCT FROM r.sector""",
    "request_branch": """
        SELECT request_id, CASE WHEN n.mct_id IS NOT NULL THEN 'store'
          WHEN p.area IS NOT NULL OR p.sector IS NOT NULL THEN 'group' ELSE 'cluster' END AS branch
        FROM (SELECT request_id, mct_id AS shop, area, sector FROM parsed) p LEFT JOIN newest n ON n.mct_id = p.shop""",
    "store_brief": _brief("brief_store"),
    "group_brief": _brief("brief_group"),
    "cluster_brief": f"SELECT * EXCLUDE (request_id, context) FROM ({_brief('brief_cluster')})",
    "brief_bundles": f"SELECT * EXCLUDE (request_id), NULL::VARCHAR AS system_prompt FROM ({_bundles})",
    "brief_json": f"""
        SELECT mct_id, ym, version, 'k,cluster_id,title,system_prompt,user_prompt,rule_text,dom_age,profile,rec_channels,rec_keywords,'
          || 'context_lines,user_input' AS fields FROM ({_bundles})""",
    "kmeans_choose_k": """
        SELECT unnest(range(3, 8)) AS k, n, true AS inertia_of_centers, true AS chosen_is_best FROM (SELECT count(*) AS n FROM features)""",
    "store_clusters": "SELECT mct_id, max(ym) AS ym, true AS nearest FROM features GROUP BY mct_id",
    "fitted_rules": """
        SELECT (count(*) - ceil(0.2 * count(*)))::BIGINT AS support, true AS full_leaves, true AS shallow, true AS no_gap FROM features""",
    "rule_assign": "SELECT DISTINCT mct_id, 5::BIGINT AS k, true AS meets_rule FROM features",
    "chart_age": """
        SELECT mct_id, ym, bucket, value, rank::BIGINT AS rank, round_even(value / 0.01, 0)::INT::VARCHAR || '%' AS label
        FROM (SELECT *, row_number() OVER (PARTITION BY mct_id, ym ORDER BY value DESC, o) AS rank FROM ("""
    + _bars(f"SELECT mct_id, ym, '{b}' AS bucket, {c}::DOUBLE AS value, {i} AS o FROM features" for i, (b, c) in enumerate(zip(AGE_BANDS, AGE_COLS)))
    + "))",
    "chart_audience": """
        SELECT mct_id, ym, metric, value, rank::BIGINT AS rank, round_even(value / 0.01, 0)::INT::VARCHAR || '%' AS label,
          CASE WHEN value <= 0.5 THEN '약함' WHEN value <= 0.75 THEN '보통' ELSE '강함' END AS band
        FROM (SELECT *, row_number() OVER (PARTITION BY mct_id, ym ORDER BY value DESC, o) AS rank FROM ("""
    + _bars(f"SELECT mct_id, ym, '{_audience_names[a]}' AS metric, {c}::DOUBLE AS value, {i} AS o FROM features" for i, (a, c) in enumerate(zip(AUDIENCES, AUD_COLS)))
    + ") WHERE value >= 0.6)",
    "profile_extract_age": _bars(
        f"SELECT cluster_id::BIGINT AS cluster_id, '{b}' AS bucket, {c} AS value FROM profile_now" for b, c in zip(AGE_BANDS, AGE_COLS)
    ),
    "profile_extract_audience": _bars(
        f"SELECT cluster_id::BIGINT AS cluster_id, '{a}' AS metric, {c} AS value FROM profile_now" for a, c in zip(AUDIENCES, AUD_COLS)
    ),
    "rounded_shares": """
        SELECT l_orderkey, l_partkey, l_linenumber::BIGINT AS l_linenumber,
          format('{:.2f}', l_extendedprice * l_discount)::DOUBLE AS v2, format('{:.3f}', l_extendedprice * l_discount)::DOUBLE AS v3
        FROM lineitem""",
}
ORACLE["store_features_joined"] = ORACLE["store_features_staged"] = ORACLE["store_features"]
ORACLE["assoc_dataset_joined"] = ORACLE["assoc_dataset"]
ORACLE["table_reload"] = ORACLE["region_age_avg"]


def oracle_sql() -> dict[str, str]:
    made = {name: _with(body) for name, body in ORACLE.items()}
    score = "SELECT round(avg(s), 8) AS silhouette, count(*) AS n FROM silhouettes"
    for name, distance in (("silhouette_fixed", _list_distance), ("silhouette_squared", _list_squared)):
        made[name] = _with(score, pair_means=_CTES["pair_means"].replace("{distance}", distance))
    score = "SELECT -1.0::DOUBLE AS one, round(avg(s), 8) AS own, count(*) AS n FROM silhouettes"
    made["silhouette_one_label"] = _with(score, pair_means=_CTES["pair_means"].replace("{distance}", _list_squared))
    return made
