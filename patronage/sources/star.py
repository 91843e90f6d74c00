"""Staging-shaped inputs derived from the star-schema sample tables.

Shops are customers, months are order months, shares are counts of order lines. Missing values,
sentinels and absent rows follow from the data itself: a month with a single line is not published
(sentinel), a month without a small basket has no shares (NULL), returns of one kind are not in the
performance table (absent rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import SENTINEL
from .delimited import as_date

_AGES = {"1020": "1-URGENT", "30": "2-HIGH", "40": "3-MEDIUM", "50": "4-NOT SPECIFIED", "60": "5-LOW"}
_SEXES = {"MAL": "F", "FME": "O"}


_SCHEMAS: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One sample table; its footer is looked at once per path."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return places.select("n_nationkey", "n_name", "r_name")


def _opened() -> Column:
    """An opening day, written in another way in each market segment."""
    year, month, day = F.col("c_nationkey") + 1990, F.col("c_custkey") % 14 + 1, F.col("c_nationkey") + 1
    pieces = [F.lpad(c.cast("string"), n, "0") for c, n in ((year, 4), (month, 2), (day, 2))]
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "BUILDING", F.concat(*pieces))
        .when(segment == "MACHINERY", F.concat_ws("/", *pieces))
        .when(segment == "HOUSEHOLD", F.concat_ws(".", year, month, day))
        .when(segment == "FURNITURE", F.concat(F.concat_ws("-", *pieces), F.lit(" 10:30:00")))
        .otherwise(F.concat_ws("-", *pieces))
    )


def stg_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    road = (
        F.when(F.col("c_mktsegment") == "BUILDING", "왕십리로")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "무학2길")
        .otherwise("행당동")
    )
    return customer.join(_places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("ENCODED_MCT"),
        F.concat_ws(" ", "r_name", "n_name", road, key).alias("MCT_BSE_AR"),
        F.col("c_name").alias("MCT_NM"),
        F.when(F.col("c_acctbal") > 8000, F.concat(F.lit("B"), F.col("c_nationkey").cast("string"))).alias("MCT_BRD_NUM"),
        F.col("r_name").alias("MCT_SIGUNGU_NM"),
        F.when(F.col("c_acctbal") >= -800, F.col("c_mktsegment")).alias("HPSN_MCT_ZCD_NM"),
        F.when(F.col("c_acctbal") <= 9700, F.col("n_name")).alias("HPSN_MCT_BZN_CD_NM"),
        as_date(_opened()).alias("ARE_D"),
        as_date(F.when(F.col("c_acctbal") < 0, F.concat(F.lit("99"), F.col("c_custkey") % 2, F.lit("131")))).alias("MCT_ME_D"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.col("o_custkey").cast("string").alias("ENCODED_MCT"),
        F.date_format("o_orderdate", "yyyyMM").alias("TA_YM"),
        F.col("o_orderpriority"),
        F.col("o_orderstatus"),
    )
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"
    )
    return orders.join(lineitem, F.col("l_orderkey") == F.col("o_orderkey"))


def _rate(condition: str) -> str:
    return f"cast(count_if({condition}) AS DOUBLE) * 100 / count(*)"


def staged_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics and performance columns of every shop month, off one pass over the lines;
    ``has_perf`` tells whether the performance table has the month."""
    return _lines(spark, sf_dir).groupBy("ENCODED_MCT", "TA_YM").agg(*_demo_columns(), *_perf_columns())


def _demo_columns() -> list[Column]:
    def published(condition: str) -> str:
        return f"CASE WHEN count(*) = 1 THEN {SENTINEL}D WHEN min(l_quantity) <= 40 THEN {_rate(condition)} END"

    shares = {
        f"M12_{sex}_{age}_RAT": f"o_orderpriority = '{word}' AND l_linestatus = '{status}'"
        for sex, status in _SEXES.items()
        for age, word in _AGES.items()
    }
    shares |= {
        "MCT_UE_CLN_REU_RAT": "l_discount >= 0.05",
        "MCT_UE_CLN_NEW_RAT": "l_discount < 0.05",
        "RC_M1_SHC_RSD_UE_CLN_RAT": "l_quantity <= 17",
        "RC_M1_SHC_WP_UE_CLN_RAT": "l_quantity > 17 AND l_quantity <= 34",
        "RC_M1_SHC_FLP_UE_CLN_RAT": "l_quantity > 34",
    }
    return [F.expr(f"{published(condition)} AS {name}") for name, condition in shares.items()]


def _perf_columns() -> list[Column]:
    pending, opened = (F.count_if(F.col("o_orderstatus") == c) > 0 for c in "PO")
    band = F.when(~pending & ~opened, "1_상위1구간").when(~pending, "HIGH").when(F.min("l_discount") < 0.05, "5_하위")
    delivery = F.count_if(F.col("l_returnflag") == "R").cast("double") / F.count("*")
    return [
        band.alias("APV_CE_RAT"),
        F.when(F.count("*") == 1, F.lit(SENTINEL)).otherwise(delivery).alias("DLV_SAA_RAT"),
        # a month with returns of one kind only isn't in the performance table
        (F.count_if(F.col("l_returnflag") != "A") > 0).alias("has_perf"),
    ]


def stg_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).groupBy("ENCODED_MCT", "TA_YM").agg(*_demo_columns())


def stg_perf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).groupBy("ENCODED_MCT", "TA_YM").agg(*_perf_columns()).filter("has_perf").drop("has_perf")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer: free text of three kinds; some name a shop, a few an unknown one."""
    customer = read_table(spark, sf_dir, "customer")
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    words = (
        F.when(segment.isin("BUILDING", "FURNITURE"), F.concat(F.lit("  "), "n_name", F.lit(" "), segment, F.lit("!! 스**커피 분석 ")))
        .when(segment == "MACHINERY", F.concat("n_name", F.lit(" 가게?")))
        .otherwise(F.lit("hello *shop*"))
    )
    shop = F.when(balance > 9500, F.lit("unknown")).when(balance > 7000, F.col("c_custkey").cast("string"))
    return customer.join(_places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("request_id"),
        words.alias("user_input"),
        shop.alias("mct_id"),
        F.lit(None).cast("string").alias("area"),
        F.lit(None).cast("string").alias("sector"),
    )


def _age_share(low: int, high: int, name: str) -> Column:
    rate = f"cast(count_if(p_size BETWEEN {low} AND {high}) AS DOUBLE) * 100 / count(*)"
    return F.expr(f"concat(cast(floor({rate}) AS STRING), '%') AS `{name}`")


_BY_AGE = [("10대", 1, 8), ("20대", 9, 16), ("30대", 17, 24), ("40대", 25, 32), ("50대", 33, 40), ("60대 이상", 41, 50)]


def media_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    table = part.groupBy(F.col("p_brand").alias("channel")).agg(*[_age_share(a, b, n) for n, a, b in _BY_AGE])
    return table.withColumn("row_ord", F.col("channel"))


def keyword_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    table = part.groupBy(F.col("p_name").alias("관심 키워드")).agg(*[_age_share(a, b, n) for n, a, b in _BY_AGE])
    return table.withColumn("row_ord", F.col("관심 키워드"))


def video_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video platforms; the brands in it clash with media channels."""
    part = read_table(spark, sf_dir, "part")
    kind = F.when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise(F.concat("p_type", F.lit(" video")))
    table = part.groupBy(kind.alias("platform")).agg(*[_age_share(a, b, n) for n, a, b in _BY_AGE])
    return table.withColumn("row_ord", F.col("platform"))


def video_transposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages down the first column, one column per platform; some headers differ in case or blanks only."""
    age = F.when(F.col("p_size") <= 8, "10대").when(F.col("p_size") <= 16, "20대")
    for label, low, high in _BY_AGE[2:]:
        age = age.when(F.col("p_size").between(low, high), label)
    kinds = {"ECONOMY": "ECONOMY", "STANDARD": "STANDARD", "Pro Mo": "PROMO", "pro_mo": "SMALL", "pro mo": "LARGE"}
    shares = [
        F.expr(f"concat(cast(floor({_rate(f"p_type = '{k}'")}) AS STRING), '%') AS {k}") for k in kinds.values()
    ]
    table = read_table(spark, sf_dir, "part").groupBy(age.alias("platform")).agg(*shares)
    # three headers are one platform, and the later two have gaps
    gaps = {"pro_mo": F.col("platform").isin("20대", "40대"), "pro mo": ~F.col("platform").isin("30대", "50대")}
    columns = [F.when(~gaps[name], F.col(k)) if name in gaps else F.col(k) for name, k in kinds.items()]
    return table.select("platform", *columns, F.col("platform")).toDF("platform", *kinds, "row_ord")


def media_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    decade = F.floor(F.col("p_size") / 9) * 10
    size = F.col("p_size").cast("string")
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_ord"),
        (decade + 10).cast("string").alias("최소나이"),
        (decade + 19).cast("string").alias("최대나이"),
        F.col("p_brand").alias("매체1"),
        size.alias("접촉률1"),
        F.col("p_type").alias("매체2"),
        F.when(F.col("p_name").startswith("small"), "-").otherwise(F.concat(size, F.lit(".5%"))).alias("접촉률2"),
    )


def interest_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    decade = F.floor(F.col("p_size") / 9) * 10
    size = F.col("p_size").cast("string")
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_ord"),
        (decade + 10).cast("string").alias("최소나이"),
        (decade + 19).cast("string").alias("최대나이"),
        F.col("p_name").alias("관심1"),
        size.alias("관심1_비율"),
        size.alias("뷰티_전체"),
    )
