"""Shop segments: fit, choose k, and the stored result tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clustering import K_LIST, Segments, choose_segments, cluster_profile
from ..operators.keyed import dedupe_last
from ..schemas import FEATURES


@dataclass(frozen=True)
class SegmentTables:
    """What one run writes. Rows are shop months while clusters are per shop: the newest month
    gives the shop its cluster."""

    segments: Segments
    clusters: DataFrame
    profile: DataFrame


def segment_tables(features: DataFrame, segments: Segments, run_ts: dt.datetime) -> SegmentTables:
    labelled = segments.label(features.select("mct_id", "ym", *FEATURES))
    stamp = F.lit(run_ts).alias("created_at")
    clusters = dedupe_last(labelled.select("mct_id", "ym", "cluster_id"), ["mct_id"], ["ym", "cluster_id"])
    return SegmentTables(
        segments=segments,
        clusters=clusters.select(
            "mct_id",
            "ym",
            "cluster_id",
            F.lit(segments.k).alias("k"),
            F.lit(segments.inertia).alias("inertia"),
            F.lit(segments.silhouette).alias("silhouette"),
            F.lit(segments.measure).alias("measure"),
            stamp,
        ),
        profile=cluster_profile(labelled, FEATURES).select(
            "cluster_id", F.lit(segments.k).alias("k"), "feature", "mean", "std", "n", stamp
        ),
    )


def segment(features: DataFrame, run_ts: dt.datetime, k: int | None = None, measure: str = "euclidean") -> SegmentTables:
    """Fit with a given k, or with the k of 3 to 7 that has the best silhouette."""
    best, _ = choose_segments(features, FEATURES, K_LIST if k is None else (k,), measure=measure)
    return segment_tables(features, best, run_ts)


def run(tables, features: DataFrame, run_ts: dt.datetime, k: int | None = None) -> SegmentTables:
    """Segment the shops and store clusters per shop and the profile history. Every run stamps the
    shops it writes, so "latest run" follows run time."""
    made = segment(features, run_ts, k)
    tables.upsert("mat_store_cluster", made.clusters, ["ym"])
    tables.append("mat_cluster_profile", made.profile, run_ts)
    return made
