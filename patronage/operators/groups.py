"""Mean profile and most frequent cluster per (area, sector) request.

Shop rows are first reduced to sums per (zone, district, sector, cluster), combined before the
shuffle. Requests are matched to those few groups by name and never to shops, and every distinct
(area, sector) pair is answered once however many requests ask for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURES
from ..session import cut_lineage
from .matching import like_matches

PLACE = ["biz_zone", "sigungu", "sector"]
PARAMS = ["area", "sector"]


def _place_sums(features: DataFrame, clusters: DataFrame, *by: str) -> DataFrame:
    rows = features.join(clusters.select("mct_id", "cluster_id"), "mct_id", "left")
    sums = [F.expr(f"sum({c}) AS sum_{c}") for c in FEATURES]
    known = [F.expr(f"count({c}) AS known_{c}") for c in FEATURES]
    return rows.groupBy(*PLACE, "cluster_id", *by).agg(*sums, *known, F.count("*").alias("n"))


def place_sums(features: DataFrame, clusters: DataFrame) -> DataFrame:
    """Feature sums, counts of known values and row counts per place and cluster. Shops without a
    cluster count under NULL."""
    return _place_sums(features, clusters)


def place_month_sums(features: DataFrame, clusters: DataFrame) -> DataFrame:
    """The same by month: what a load of some months adds to the stored sums."""
    return _place_sums(features, clusters, "ym")


def merged_place_sums(by_month: DataFrame) -> DataFrame:
    """The sums per place and cluster out of those by month."""
    totals = [f"{kind}_{c}" for kind in ("sum", "known") for c in FEATURES] + ["n"]
    return by_month.groupBy(*PLACE, "cluster_id").agg(*[F.expr(f"sum({c}) AS {c}") for c in totals])


def _same(left: str, right: str, columns: list[str]):
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def matched_places(params: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct (area, sector) parameters with each place that meets them. A NULL parameter sets no
    condition; an area may be named by the zone or by the district."""
    asked, where = params.select(*PARAMS), places.select(*PLACE).distinct()
    zones = where.select(F.explode(F.array("biz_zone", "sigungu")).alias("value"))
    area_hits = like_matches(asked.select(F.col("area").alias("param")), zones)
    sector_hits = like_matches(
        asked.select(F.col("sector").alias("param")), where.select(F.col("sector").alias("value"))
    )
    # one row per name a place goes by, so that the area meets it in an equi-join
    named = where.select("*", F.explode(F.array_distinct(F.array("biz_zone", "sigungu"))).alias("_area_name"))
    place = F.struct(*PLACE).alias("place")

    in_area = area_hits.join(named, F.col("value") == F.col("_area_name"))
    in_area = in_area.select(F.col("param").alias("area"), place).distinct()
    in_sector = sector_hits.select(F.col("param").alias("sector"), F.col("value").alias("place_sector"))

    by_area = asked.filter(F.col("area").isNotNull()).join(in_area, "area")
    only_area = by_area.filter(F.col("sector").isNull()).select(*PARAMS, "place")
    both = (
        by_area.withColumn("place_sector", F.col("place.sector"))
        .join(in_sector, ["sector", "place_sector"])
        .select(*PARAMS, "place")
    )
    only_sector = (
        asked.filter(F.col("area").isNull() & F.col("sector").isNotNull())
        .join(in_sector, "sector")
        .join(where.select(place, F.col("sector").alias("place_sector")), "place_sector")
        .select(*PARAMS, "place")
    )
    # at most one parameter pair is without any condition; it takes every place
    anything = asked.agg(F.bool_or(F.col("area").isNull() & F.col("sector").isNull())).scalar()
    none = F.lit(None).cast("string")
    everything = where.filter(anything).select(none.alias("area"), none.alias("sector"), place)
    return only_area.unionByName(both).unionByName(only_sector).unionByName(everything)


def group_profiles(params: DataFrame, sums: DataFrame) -> DataFrame:
    """Per distinct (area, sector): 12 means, row count and most frequent cluster.

    Pairs that no shop meets have NULL means and cluster 0. Equally frequent clusters: smallest id.
    """
    # both are small next to requests and shops, and the match reads each several times
    asked = cut_lineage(params.select(*PARAMS).distinct())
    sums = cut_lineage(sums)
    hits = matched_places(asked, sums).select(
        *PARAMS, *[F.col(f"place.{c}").alias(f"_{c}") for c in PLACE]
    )
    on = F.lit(True)
    for c in PLACE:
        on = on & F.col(f"h._{c}").eqNullSafe(F.col(f"s.{c}"))
    columns = [f"h.{c}" for c in PARAMS] + [f"s.{c}" for c in sums.columns if c not in PLACE]
    met = hits.alias("h").join(sums.alias("s"), on).select(columns)
    totals = [c for c in sums.columns if c not in (*PLACE, "cluster_id")]
    per_cluster = met.groupBy(*PARAMS, "cluster_id").agg(*[F.expr(f"sum({c}) AS {c}") for c in totals])
    most = F.max_by("cluster_id", F.when(F.col("cluster_id").isNotNull(), F.struct("n", -F.col("cluster_id"))))
    summed = per_cluster.groupBy(*PARAMS).agg(
        most.alias("cluster_id"), *[F.expr(f"sum({c}) AS {c}") for c in totals]
    )
    means = [
        F.expr(f"cast(cast(sum_{c} AS DECIMAL(28,4)) / cast(nullif(known_{c}, 0) AS DECIMAL(18,0)) AS DECIMAL(12,8)) AS {c}")
        for c in FEATURES
    ]
    found = summed.select(*PARAMS, "cluster_id", "n", *means)
    joined = asked.alias("a").join(found.alias("f"), _same("a", "f", PARAMS), "left")
    return joined.select(
        "a.area",
        "a.sector",
        F.coalesce("f.cluster_id", F.lit(0)).alias("cluster_id"),
        F.coalesce("f.n", F.lit(0)).alias("n"),
        *[f"f.{c}" for c in FEATURES],
    )


def attach(requests: DataFrame, answers: DataFrame, on: list[str] = PARAMS, how: str = "left") -> DataFrame:
    """Each request with the answer for its (area, sector), or for all of the columns given."""
    rest = [f"p.{c}" for c in answers.columns if c not in on]
    joined = requests.alias("r").join(answers.alias("p"), _same("r", "p", on), how)
    return joined.select("r.*", *rest)
