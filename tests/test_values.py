"""Column expressions against hand tables and plain Python."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronage.functions.numbers import (
    SENTINEL,
    above_half,
    first_largest,
    fixed_text,
    mentions_high,
    part_of,
    percent_label,
    round_half_even,
    share,
    strength_band,
)
from patronage.functions.stats import chi_square_tail
from patronage.functions.text import (
    age_group,
    channel_name,
    header_age_group,
    keyword_name,
    masked_tokens,
    normalize_text,
    parse_ratio,
    road_name,
    span_age_group,
)

# letters that both the JVM and Python know; each has its own Unicode version
LETTERS = st.one_of(
    st.characters(max_codepoint=0x7FF, exclude_characters="\x00"),
    st.characters(min_codepoint=0x2000, max_codepoint=0x24FF),
    st.characters(min_codepoint=0xAC00, max_codepoint=0xD7A3),
    st.sampled_from(" \u3000*_-!\x1c\x85"),
)
FEW = settings(max_examples=8, deadline=None)


def column(spark, values, kind, build):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build).collect()]


def pairs(spark, table, build):
    assert column(spark, list(table), "string", build) == list(table.values())


def test_age_group(spark):
    table = {
        "10대": "10s", "20대 여성": "10s", " TEENS ": "10s", "1020": "10s", "10~20": "10s", "30대": "30s", "40s": "40s",
        "age 50": "50s", "60대 이상": "60p", "60+": "60p", "70대": None, "70대 이상": "60p", "고령층": "60p", "100": "10s",
        "": None, "매체": None, "3 0": None, "35-44": None,
    }
    pairs(spark, table, age_group("v"))
    assert {k: header_age_group(k) for k in table} == table
    assert column(spark, [None], "string", age_group("v")) == [None]


def test_parse_ratio(spark):
    table = {
        "35": 0.35, "0.35": 0.35, "35%": 0.35, "1%": 1.0, "0.5%": 0.5, "1,000": None, "10,0": 1.0, "100": 1.0, "100.1": None,
        "-": None, "--": None, "": None, " ": None, "nan": None, "NaN": None, "NA": None, "na": None, "None": None,
        "-999999.9": None, "-0.1": None, "abc": None, "35 %": 0.35, " 35 ": 0.35, "1e-1": 0.1, "5d": None, "0x1": None,
        "inf": None, ".5": 0.5, "5.": 0.05, "+7": 0.07, "%": None, "1_0": 0.1, "33.33333": 0.3333, "35%%": None, "0": 0.0,
    }
    pairs(spark, table, parse_ratio("v"))
    assert column(spark, [None], "string", parse_ratio("v")) == [None]


def test_span_age_group(spark):
    df = spark.createDataFrame(
        [("10", "19"), ("25", "34"), ("30", "39"), ("35", "45"), ("50", "59"), ("60", "99"), (None, "19"), ("x", "19"), (" 20 ", "29"),
         ("30d", "39"), ("30", "39f"), ("3_0", "39"), ("1e1", "19")],
        "a string, b string",
    )
    got = [r[0] for r in df.select(span_age_group("a", "b")).collect()]
    assert got == ["10s", "10s", "30s", "40s", "50s", "60p", "60p", None, "10s", None, None, "30s", "10s"]


def test_names(spark):
    pairs(spark, {" You Tube ": "you_tube", "nan": None, "None": None, "": None, "TV": "tv"}, channel_name("v"))
    pairs(spark, {" 맛 집 ": "맛집", "NaN": None, "Cafe Latte": "CafeLatte", "none": None}, keyword_name("v"))


def test_texts(spark):
    pairs(
        spark,
        {
            "  성동구  왕십리!! 스**커피 ": "성동구 왕십리 스**커피",
            "a-b_c": "a b_c",
            "!!": " ",
            "": "",
            "½ ② é": "½ ② é",
            " 　x\t\ny": "x y",
        },
        normalize_text("v"),
    )
    pairs(spark, {"a 스** b *x": "스** *x", "abc": None, "": None}, masked_tokens("v"))
    pairs(
        spark,
        {"서울특별시 성동구 왕십리로 83": "서울특별시 성동구 왕십리로", "서울 행당동 1": None, "무학2길,왕십리로": "무학2길"},
        road_name("v"),
    )


@FEW
@given(texts=st.lists(st.text(LETTERS, max_size=30), min_size=30, max_size=60))
def test_normalize_like_python(spark, texts):
    want = [re.sub(r"\s+", " ", re.sub(r"[^\w가-힣\s\*]", " ", t.strip())) for t in texts]
    assert column(spark, texts, "string", normalize_text("v")) == want


@FEW
@given(values=st.lists(st.one_of(st.floats(0, 1e6), st.integers(0, 4000).map(lambda i: i / 1000)), min_size=50, max_size=200))
def test_rounding_like_python(spark, values):
    assert column(spark, values, "double", round_half_even("v", 2)) == [round(v, 2) for v in values]
    assert column(spark, values, "double", round_half_even("v", 4)) == [round(v, 4) for v in values]
    assert column(spark, values, "double", fixed_text("v", 2)) == [f"{v:.2f}" for v in values]


def test_ties_by_binary_value(spark):
    assert column(spark, [0.125, 0.375, 0.345, 0.285], "double", fixed_text("v", 2)) == ["0.12", "0.38", "0.34", "0.28"]


def test_shares_and_flags(spark):
    values = [None, SENTINEL, -5.0, 0.0, 35.0, 100.0, 250.0]
    assert column(spark, values, "double", share("v")) == [0, 0, 0, 0, 0.35, 1, 1]
    assert column(spark, [None, SENTINEL, 0.5, 0.51, 35.0], "double", above_half("v")) == [0, 0, 0, 1, 1]
    pairs(spark, {"1_상위1구간": 1, "HIGH": 1, "5_하위": 0, "highest": 1, "": 0}, mentions_high("v"))
    assert column(spark, [None], "string", mentions_high("v")) == [0]
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    assert [float(r[0]) for r in df.select(part_of("a", "b")).collect()] == [0.3333, 0.0, 0.0]


def test_first_largest(spark):
    df = spark.createDataFrame([(0.2, 0.5, 0.5), (0.0, 0.0, 0.0), (None, -1.0, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(first_largest(["A", "B", "C"], ["a", "b", "c"])).collect()] == ["B", "A", "A"]


def test_chart_values(spark):
    values = [0.5, 0.51, 0.75, 0.76, 0.125]
    assert column(spark, values, "double", strength_band("v")) == ["약함", "보통", "보통", "강함", "약함"]
    assert column(spark, values, "double", percent_label("v")) == ["50%", "51%", "75%", "76%", "12%"]


def test_chi_square_tail(spark):
    df = spark.createDataFrame([(3.84, 1), (40.0, 1), (9.5, 4), (5.0, 0), (0.0, 3)], "x double, d int")
    got = [r[0] for r in df.select(chi_square_tail(F.col("x"), F.col("d"))).collect()]
    want = [math.erfc(math.sqrt(1.92)), math.erfc(math.sqrt(20.0)), math.exp(-4.75) * 5.75, 1.0, 1.0]
    assert all(math.isclose(g, w, rel_tol=1e-9) for g, w in zip(got, want))
