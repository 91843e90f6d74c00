"""Declared table shapes. Keys are unique by way of the keyed writes, Spark does not enforce them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

AGE_BANDS = ["10s", "30s", "40s", "50s", "60p"]
AUDIENCES = ["NEW", "REU", "RES", "WORK", "FLOW"]
AGE_COLS = [f"age_{b}" for b in AGE_BANDS]
AUD_COLS = [f"aud_{a.lower()}" for a in AUDIENCES]
FLAG_COLS = ["cancel_high", "delivery_high"]
FEATURES = AGE_COLS + AUD_COLS + FLAG_COLS

RATIO = T.DecimalType(6, 4)

# The declared columns of each table.
COLUMNS: dict[str, str] = {
    "stg_store": (
        "ENCODED_MCT string, MCT_BSE_AR string, MCT_NM string, MCT_BRD_NUM string, "
        "MCT_SIGUNGU_NM string, HPSN_MCT_ZCD_NM string, HPSN_MCT_BZN_CD_NM string, ARE_D date, "
        "MCT_ME_D date"
    ),
    "stg_perf": (
        "ENCODED_MCT string, TA_YM string, MCT_OPE_MS_CN string, RC_M1_SAA decimal(12,2), "
        "RC_M1_TO_UE_CT decimal(12,2), RC_M1_UE_CUS_CN string, RC_M1_AV_NP_AT decimal(12,2), "
        "APV_CE_RAT string, DLV_SAA_RAT decimal(12,4), M1_SME_RY_SAA_RAT decimal(12,4), "
        "M1_SME_RY_CNT_RAT decimal(12,4), M12_SME_RY_SAA_PCE_RT decimal(12,4), "
        "M12_SME_BZN_SAA_PCE_RT decimal(12,4), M12_SME_RY_ME_MCT_RAT decimal(12,4), "
        "M12_SME_BZN_ME_MCT_RAT decimal(12,4)"
    ),
    "stg_demo": (
        "ENCODED_MCT string, TA_YM string, M12_MAL_1020_RAT decimal(12,4), "
        "M12_MAL_30_RAT decimal(12,4), M12_MAL_40_RAT decimal(12,4), M12_MAL_50_RAT decimal(12,4), "
        "M12_MAL_60_RAT decimal(12,4), M12_FME_1020_RAT decimal(12,4), M12_FME_30_RAT decimal(12,4), "
        "M12_FME_40_RAT decimal(12,4), M12_FME_50_RAT decimal(12,4), M12_FME_60_RAT decimal(12,4), "
        "MCT_UE_CLN_REU_RAT decimal(12,4), MCT_UE_CLN_NEW_RAT decimal(12,4), "
        "RC_M1_SHC_RSD_UE_CLN_RAT decimal(12,4), RC_M1_SHC_WP_UE_CLN_RAT decimal(12,4), "
        "RC_M1_SHC_FLP_UE_CLN_RAT decimal(12,4)"
    ),
    "dim_store": (
        "mct_id string, name string, sector string, biz_zone string, sigungu string, addr string, "
        "road_name string, brand_code string, open_dt date, close_dt date"
    ),
    "fx_age_mix": (
        "mct_id string, ym string, age_10s decimal(6,4), age_30s decimal(6,4), age_40s decimal(6,4), "
        "age_50s decimal(6,4), age_60p decimal(6,4)"
    ),
    "fx_audience_type": (
        "mct_id string, ym string, NEW decimal(6,4), REU decimal(6,4), RES decimal(6,4), "
        "WORK decimal(6,4), FLOW decimal(6,4)"
    ),
    "fx_perf_flags": (
        "mct_id string, ym string, cancel_high int, delivery_high int"
    ),
    "fx_region_age_avg": (
        "sector string, biz_zone string, ym string, age_10s decimal(6,4), age_30s decimal(6,4), "
        "age_40s decimal(6,4), age_50s decimal(6,4), age_60p decimal(6,4)"
    ),
    "dim_age_affinity_media": (
        "version string, age_group string, channel string, affinity decimal(6,4)"
    ),
    "dim_age_affinity_keyword": (
        "version string, age_group string, keyword string, affinity decimal(6,4)"
    ),
    "mat_age_channel_score": (
        "mct_id string, ym string, version string, channel string, score decimal(8,4)"
    ),
    "mat_age_keyword_score": (
        "mct_id string, ym string, version string, keyword string, score decimal(8,4)"
    ),
    "mat_prompt_bundle": (
        "mct_id string, ym string, version string, bundle string"
    ),
    "fx_age_bucket": (
        "mct_id string, ym string, age_bucket string"
    ),
    "fx_aud_bucket": (
        "mct_id string, ym string, aud_bucket string"
    ),
    "mat_assoc": (
        "pair_name string, chi2 double, dof int, p_value double, cramers_v double, n bigint, "
        "created_at timestamp"
    ),
    "mat_store_cluster": (
        "mct_id string, ym string, cluster_id int, k int, inertia double, silhouette double, "
        "measure string, created_at timestamp"
    ),
    "mat_cluster_profile": (
        "cluster_id int, k int, feature string, mean double, std double, n bigint, "
        "created_at timestamp"
    ),
    "mat_tree_rules": (
        "rule_id bigint, k int, depth int, cluster_id int, rule_text string, support bigint, "
        "rule_precision double, train_acc double, created_at timestamp"
    ),
    "mat_store_rule_assign": (
        "mct_id string, k int, rule_id bigint, cluster_id int, created_at timestamp"
    ),
    "agg_place_month": (
        "biz_zone string, sigungu string, sector string, cluster_id int, ym string, "
        + ", ".join(f"sum_{c} {'bigint' if c in FLAG_COLS else 'decimal(38,4)'}" for c in FEATURES)
        + "".join(f", known_{c} bigint" for c in FEATURES)
        + ", n bigint"
    ),
}

class _Schemas(Mapping):
    """The same as types; parsed on first use, for which Spark needs a running session."""

    def __getitem__(self, table: str) -> T.StructType:
        return _parsed(COLUMNS[table])

    def __iter__(self) -> Iterator[str]:
        return iter(COLUMNS)

    def __len__(self) -> int:
        return len(COLUMNS)


@cache
def _parsed(columns: str) -> T.StructType:
    return T.StructType.fromDDL(columns)


SCHEMAS = _Schemas()

KEYS: dict[str, list[str]] = {
    "stg_store": ["ENCODED_MCT"],
    "stg_perf": ["ENCODED_MCT", "TA_YM"],
    "stg_demo": ["ENCODED_MCT", "TA_YM"],
    "dim_store": ["mct_id"],
    "fx_age_mix": ["mct_id", "ym"],
    "fx_audience_type": ["mct_id", "ym"],
    "fx_perf_flags": ["mct_id", "ym"],
    "fx_region_age_avg": ["sector", "biz_zone", "ym"],
    "dim_age_affinity_media": ["version", "age_group", "channel"],
    "dim_age_affinity_keyword": ["version", "age_group", "keyword"],
    "mat_age_channel_score": ["mct_id", "ym", "version", "channel"],
    "mat_age_keyword_score": ["mct_id", "ym", "version", "keyword"],
    "mat_prompt_bundle": ["mct_id", "ym", "version"],
    "fx_age_bucket": ["mct_id", "ym"],
    "fx_aud_bucket": ["mct_id", "ym"],
    "mat_assoc": ["pair_name", "created_at"],
    "mat_store_cluster": ["mct_id"],
    "mat_cluster_profile": ["cluster_id", "k", "feature", "created_at"],
    "mat_tree_rules": ["rule_id"],
    "mat_store_rule_assign": ["mct_id", "k"],
    "agg_place_month": ["biz_zone", "sigungu", "sector", "cluster_id", "ym"],
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    """The table with its declared columns and no rows."""
    return spark.createDataFrame([], SCHEMAS[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Declared columns in declared order and type; columns the frame lacks become NULL."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        [
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS[table].fields
        ]
    )
