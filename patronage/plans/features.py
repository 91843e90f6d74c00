"""Feature tables per shop and month out of the staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import above_half, first_largest, mentions_high, part_of, share
from ..functions.text import road_name
from ..operators.groups import merged_place_sums, place_month_sums
from ..schemas import AGE_BANDS, AGE_COLS, AUD_COLS, AUDIENCES, FEATURES, RATIO

# Source columns behind each feature.
_AGE_CODES = dict(zip(AGE_COLS, ["1020", "30", "40", "50", "60"]))
_AUD_SOURCES = {
    "NEW": "MCT_UE_CLN_NEW_RAT",
    "REU": "MCT_UE_CLN_REU_RAT",
    "RES": "RC_M1_SHC_RSD_UE_CLN_RAT",
    "WORK": "RC_M1_SHC_WP_UE_CLN_RAT",
    "FLOW": "RC_M1_SHC_FLP_UE_CLN_RAT",
}
_STORE_SOURCES = {
    "mct_id": "ENCODED_MCT",
    "name": "MCT_NM",
    "sector": "HPSN_MCT_ZCD_NM",
    "biz_zone": "HPSN_MCT_BZN_CD_NM",
    "sigungu": "MCT_SIGUNGU_NM",
    "addr": "MCT_BSE_AR",
    "brand_code": "MCT_BRD_NUM",
    "open_dt": "ARE_D",
    "close_dt": "MCT_ME_D",
}


def _keyed(staged: DataFrame) -> DataFrame:
    return staged.withColumnsRenamed({"ENCODED_MCT": "mct_id", "TA_YM": "ym"})


def dim_store(stg_store: DataFrame) -> DataFrame:
    columns = [F.col(source).alias(name) for name, source in _STORE_SOURCES.items()]
    place = list(_STORE_SOURCES).index("addr") + 1
    return stg_store.select(*columns[:place], road_name("MCT_BSE_AR").alias("road_name"), *columns[place:])


def _with_age_mix(keyed: DataFrame) -> DataFrame:
    """Both sexes per band, each band over the sum of all bands."""
    sums = {
        f"_sum_{c}": share(f"M12_MAL_{code}_RAT") + share(f"M12_FME_{code}_RAT") for c, code in _AGE_CODES.items()
    }
    summed = keyed.withColumns(sums).withColumn("_total", F.expr(" + ".join(sums)))
    return summed.withColumns({c: part_of(f"_sum_{c}", "_total") for c in AGE_COLS})


def _audience(source: str) -> Column:
    return F.round(share(source), 4).cast(RATIO)


def age_mix(stg_demo: DataFrame) -> DataFrame:
    return _with_age_mix(_keyed(stg_demo)).select("mct_id", "ym", *AGE_COLS)


def audience_type(stg_demo: DataFrame) -> DataFrame:
    return _keyed(stg_demo).select(
        "mct_id", "ym", *[_audience(source).alias(name) for name, source in _AUD_SOURCES.items()]
    )


def perf_flags(stg_perf: DataFrame) -> DataFrame:
    return _keyed(stg_perf).select(
        "mct_id",
        "ym",
        mentions_high("APV_CE_RAT").alias("cancel_high"),
        above_half("DLV_SAA_RAT").alias("delivery_high"),
    )


def region_age_avg(ages: DataFrame, stg_store: DataFrame) -> DataFrame:
    """Mean age mix per sector, zone and month. Sums of short decimals are exact and combine
    before the shuffle, so a sector that holds most rows is no hot task."""
    shops = stg_store.select(
        F.col("ENCODED_MCT").alias("mct_id"),
        F.col("HPSN_MCT_ZCD_NM").alias("sector"),
        F.col("HPSN_MCT_BZN_CD_NM").alias("biz_zone"),
    ).filter(F.col("sector").isNotNull() & F.col("biz_zone").isNotNull())
    joined = ages.join(shops, "mct_id")
    return joined.groupBy("sector", "biz_zone", "ym").agg(*[F.avg(c).cast(RATIO).alias(c) for c in AGE_COLS])


def store_features(
    ages: DataFrame, audiences: DataFrame, flags: DataFrame, stores: DataFrame, latest_only: bool = False
) -> DataFrame:
    """The wide feature rows the models and briefs read, from the stored feature tables.

    Age and audience rows join inner, flags and shop attributes left, so a month without
    performance data has NULL flags. ``latest_only`` keeps the newest month per shop.
    """
    renamed = audiences.withColumnsRenamed(dict(zip(AUDIENCES, AUD_COLS)))
    return _finish(ages.join(renamed, ["mct_id", "ym"]), flags, stores, latest_only)


def store_features_from_staging(
    stg_demo: DataFrame, stg_perf: DataFrame, stg_store: DataFrame, latest_only: bool = False
) -> DataFrame:
    """The same rows straight from staging: age and audience columns come off one scan of the
    demographics, which spares the self-join on its key."""
    demo = _with_age_mix(_keyed(stg_demo)).select(
        "mct_id",
        "ym",
        *AGE_COLS,
        *[_audience(_AUD_SOURCES[name]).alias(c) for name, c in zip(AUDIENCES, AUD_COLS)],
    )
    return _finish(demo, perf_flags(stg_perf), dim_store(stg_store), latest_only)


def store_features_from_months(months: DataFrame, stg_store: DataFrame, latest_only: bool = False) -> DataFrame:
    """The same rows from staged months that hold demographics and performance side by side, with
    ``has_perf`` false where the performance table lacks the month: no join on the month at all.

    Ages are worked out before the join with the shops and the rest after it: all in one step are a
    method too long for the JVM to compile.
    """
    keyed = _keyed(months)
    rest = [*_AUD_SOURCES.values(), "APV_CE_RAT", "DLV_SAA_RAT", "has_perf"]
    if latest_only:
        newest = F.struct(*[c for c in keyed.columns if c != "mct_id"])
        keyed = keyed.groupBy("mct_id").agg(F.max_by(newest, "ym").alias("_row")).select("mct_id", "_row.*")
    shops = dim_store(stg_store).select("mct_id", "sector", "biz_zone", "sigungu")
    wide = _with_age_mix(keyed).select("mct_id", "ym", *AGE_COLS, *rest).join(shops, "mct_id", "left")
    flags = [
        F.when(F.col("has_perf"), flag).alias(name)
        for name, flag in (("cancel_high", mentions_high("APV_CE_RAT")), ("delivery_high", above_half("DLV_SAA_RAT")))
    ]
    audiences = [_audience(_AUD_SOURCES[name]).alias(c) for name, c in zip(AUDIENCES, AUD_COLS)]
    return wide.select("mct_id", "ym", "sector", "biz_zone", "sigungu", *AGE_COLS, *audiences, *flags)


def _finish(rows: DataFrame, flags: DataFrame, stores: DataFrame, latest_only: bool) -> DataFrame:
    return _with_shops(rows.join(flags, ["mct_id", "ym"], "left"), stores, latest_only)


def _with_shops(wide: DataFrame, stores: DataFrame, latest_only: bool) -> DataFrame:
    if latest_only:
        rest = F.struct("ym", *FEATURES)
        wide = wide.groupBy("mct_id").agg(F.max_by(rest, "ym").alias("_row")).select("mct_id", "_row.*")
    shops = stores.select("mct_id", "sector", "biz_zone", "sigungu")
    return wide.join(shops, "mct_id", "left").select("mct_id", "ym", "sector", "biz_zone", "sigungu", *FEATURES)


def age_bucket(ages: DataFrame) -> DataFrame:
    return ages.select("mct_id", "ym", dominant_age().alias("age_bucket"))


def aud_bucket(audiences: DataFrame) -> DataFrame:
    return audiences.select(
        "mct_id", "ym", first_largest(AUDIENCES, AUDIENCES).alias("aud_bucket")
    )


def dominant_age() -> Column:
    """Age band with the largest share; the younger band wins a tie, missing shares count as 0."""
    return first_largest(AGE_BANDS, AGE_COLS)


def build_all(stg_store: DataFrame, stg_perf: DataFrame, stg_demo: DataFrame) -> dict[str, DataFrame]:
    """All feature tables by name."""
    ages, audiences = age_mix(stg_demo), audience_type(stg_demo)
    return {
        "dim_store": dim_store(stg_store),
        "fx_age_mix": ages,
        "fx_audience_type": audiences,
        "fx_perf_flags": perf_flags(stg_perf),
        "fx_region_age_avg": region_age_avg(ages, stg_store),
        "fx_age_bucket": age_bucket(ages),
        "fx_aud_bucket": aud_bucket(audiences),
    }


def rebuild(tables, months: list[str] | None = None) -> None:
    """Refresh the stored feature tables from the stored staging tables; with ``months`` only these are
    read and written. Means per region are per month as well, so no other month changes."""
    stg_store, stg_perf, stg_demo = tables.read("stg_store"), *(tables.read(t, months=months) for t in ("stg_perf", "stg_demo"))
    tables.upsert("dim_store", dim_store(stg_store), ["mct_id"])
    tables.upsert("fx_age_mix", age_mix(stg_demo), ["mct_id", "ym"])
    tables.upsert("fx_audience_type", audience_type(stg_demo), ["mct_id", "ym"])
    tables.upsert("fx_perf_flags", perf_flags(stg_perf), ["mct_id", "ym"])
    # later tables read what is stored now, which may hold shops of earlier loads
    ages, audiences = (tables.read(t, months=months) for t in ("fx_age_mix", "fx_audience_type"))
    tables.upsert("fx_region_age_avg", region_age_avg(ages, stg_store), ["sector", "biz_zone", "ym"])
    tables.upsert("fx_age_bucket", age_bucket(ages), ["mct_id", "ym"])
    tables.upsert("fx_aud_bucket", aud_bucket(audiences), ["mct_id", "ym"])


def refresh_places(tables, months: list[str] | None = None) -> DataFrame:
    """Stored sums per place, cluster and month, of all months or of those that a load has brought, and
    the sums over all stored months. A new run of the segments needs all months again."""
    wide = store_features(
        *[tables.read(t, months=months) for t in ("fx_age_mix", "fx_audience_type", "fx_perf_flags")], tables.read("dim_store")
    )
    fresh = place_month_sums(wide, tables.read("mat_store_cluster"))
    (tables.write if months is None else tables.overwrite_months)("agg_place_month", fresh)
    return merged_place_sums(tables.read("agg_place_month"))
