"""Standardising, k-means and the choice of k."""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import frexp

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kmeans, silhouette

SEED = 42
K_LIST = (3, 4, 5, 6, 7)
MEASURES = ("euclidean", "squared")
WEIGHT, POINT_ID, KEY = "weight", "point_id", "sample_key"


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations per feature; a constant feature scales by 1."""

    features: list[str]
    means: list[float]
    deviations: list[float]

    def columns(self) -> list[Column]:
        triples = zip(self.features, self.means, self.deviations)
        return [F.expr(f"(cast({f} AS DOUBLE) - {m!r}D) / {d!r}D AS z_{f}") for f, m, d in triples]


def fill_missing(df: DataFrame, features: list[str]) -> DataFrame:
    """Features as doubles, missing ones (NULL or NaN) as 0."""
    return df.withColumns({f: F.expr(f"coalesce(nanvl(cast({f} AS DOUBLE), 0D), 0D)") for f in features})


def distinct_points(df: DataFrame, features: list[str]) -> DataFrame:
    """Equal rows as one weighted point. Rows combine before the shuffle, so a profile that a third
    of all shops share is one point; every later pass reads these points."""
    return fill_missing(df, features).groupBy(*features).agg(F.count("*").alias(WEIGHT))


def _exact_sums(points: DataFrame, terms: dict[str, str], largest: dict[str, float], weight: str) -> dict[str, float]:
    """Weighted sums of doubles that don't depend on the order of rows: every term becomes a whole
    number of units, about 2**-50 of its largest value."""
    units = {n: 2.0 ** (frexp(largest[n])[1] - 50) for n in terms}
    found = points.agg(
        *[F.expr(f"sum(cast(rint(({t}) / {units[n]!r}D) AS DECIMAL(18, 0)) * cast({weight} AS DECIMAL(18, 0))) AS {n}") for n, t in terms.items()]
    ).first()
    return {n: int(found[n]) * units[n] for n in terms}


def fit_scaler(points: DataFrame, features: list[str], weight: str | None = WEIGHT) -> Scaler:
    """Means, then squares around the means, so large counts cost no precision; sums are exact, so the
    scaler is the same on any number of partitions."""
    w = weight or "1"
    ends = points.agg(
        F.expr(f"sum(cast({w} AS DECIMAL(18, 0)))").alias("_n"),
        *[F.expr(f"min(cast({f} AS DOUBLE)) AS low_{f}") for f in features],
        *[F.expr(f"max(cast({f} AS DOUBLE)) AS high_{f}") for f in features],
    ).first()
    if any(ends[f"low_{f}"] is None for f in features):
        raise ValueError("no rows to standardise")
    low, high, n = [ends[f"low_{f}"] for f in features], [ends[f"high_{f}"] for f in features], int(ends["_n"])
    sums = _exact_sums(
        points, {f: f"cast({f} AS DOUBLE)" for f in features}, {f: max(-a, b) for f, a, b in zip(features, low, high)}, w
    )
    means = [sums[f] / n for f in features]
    squares = _exact_sums(
        points,
        {f: f"pow(cast({f} AS DOUBLE) - {m!r}D, 2)" for f, m in zip(features, means)},
        {f: max(m - a, b - m, 0.0) ** 2 for f, m, a, b in zip(features, means, low, high)},
        w,
    )
    deviations = [1.0 if a == b else (squares[f] / n) ** 0.5 for f, a, b in zip(features, low, high)]
    return Scaler(list(features), means, deviations)


def standardize(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Kept columns and each feature as (x - mean) / population deviation, off one plan: the
    statistics are a scalar subquery."""
    filled = fill_missing(df, features)
    stats = filled.agg(
        F.struct(
            *[F.expr(f"avg({f}) AS mean_{f}") for f in features],
            *[F.expr(f"if(min({f}) = max({f}), 1D, stddev_pop({f})) AS dev_{f}") for f in features],
        )
    ).scalar()
    scaled = filled.select(*keep, *features, stats.alias("_s"))
    return scaled.select(*keep, *[F.expr(f"({f} - _s.mean_{f}) / _s.dev_{f} AS {f}") for f in features])


def _nearest(centers: list[list[float]], dims: list[str]) -> Column:
    """(distance, cluster_id) of the closest centre, the smaller id of equals; distances are squared."""
    rows = []
    for i, center in enumerate(centers):
        squares = " + ".join(f"pow({d} - {x!r}D, 2)" for d, x in zip(dims, center))
        rows.append(F.expr(f"named_struct('distance', {squares}, 'cluster_id', {i})"))
    return F.array_min(F.array(*rows))


@dataclass(frozen=True)
class Segments:
    """A fitted segmentation. Clusters are ordered by size, then by centre, so that their ids do not
    depend on the order in which k-means found them."""

    k: int
    centers: list[list[float]]
    scaler: Scaler
    inertia: float
    silhouette: float
    measure: str

    def nearest(self) -> Column:
        """(distance, cluster_id) of a row with the scaled features (`z_...`)."""
        return _nearest(self.centers, [f"z_{f}" for f in self.scaler.features])

    def label(self, df: DataFrame) -> DataFrame:
        """Every row with its cluster id; a map over the rows."""
        filled = fill_missing(df, self.scaler.features)
        scaled = filled.select("*", *self.scaler.columns())
        labelled = scaled.withColumn("cluster_id", self.nearest()["cluster_id"])
        return labelled.drop(*[f"z_{f}" for f in self.scaler.features])


def _ordered(fit: kmeans.Fit) -> list[list[float]]:
    centers = (fit.centers / 2.0**kmeans.GRID_BITS).tolist()
    return [centers[i] for i in sorted(range(len(centers)), key=lambda i: (-fit.sizes[i], centers[i]))]


def choose_segments(
    df: DataFrame,
    features: list[str],
    k_list: tuple[int, ...] = K_LIST,
    seed: int = SEED,
    measure: str = "euclidean",
    starts: int = kmeans.STARTS,
) -> tuple[Segments, list[Segments]]:
    """The segmentation with the best silhouette (a tie keeps the smaller k), and all candidates.

    ``measure`` is the kind of distance in the silhouette: "euclidean", plain distances of a sample of
    rows to all others, as large as telling the candidates apart takes; or "squared", of all rows.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure is one of {MEASURES}")
    raw = silhouette.numbered(distinct_points(df, features), POINT_ID)
    scaler = fit_scaler(raw, features)
    dims = [f"z_{f}" for f in features]
    key = kmeans.sample_key(WEIGHT, features, seed).alias(KEY)
    points = raw.select(POINT_ID, WEIGHT, key, *scaler.columns())
    grid = F.array(*[F.rint(F.col(d) * 2.0**kmeans.GRID_BITS).cast("long") for d in dims]).alias("x")
    cached = points.select(WEIGHT, KEY, grid).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = kmeans.fit_all(cached, k_list, WEIGHT, KEY, seed, starts)
    finally:
        cached.unpersist()
    made = [Segments(k, _ordered(fits[k]), scaler, 0.0, 0.0, measure) for k in k_list]

    near = {f"label_{s.k}": s.nearest().alias(f"label_{s.k}") for s in made}
    found = points.select("*", *near.values())
    # decimals, whose sums don't depend on the order of rows
    inertias = found.agg(*[F.sum((F.col(WEIGHT) * F.col(n)["distance"]).cast("decimal(28,12)")).cast("double").alias(n) for n in near]).first()
    labelled = found.withColumns({n: F.col(n)["cluster_id"] for n in near})
    if measure == "euclidean":
        scores = silhouette.sampled(labelled, dims, list(near), WEIGHT, KEY)
    else:
        scores = silhouette.squared(labelled, dims, list(near), WEIGHT)
    made = [replace(s, inertia=inertias[n], silhouette=scores[n]) for s, n in zip(made, near)]
    best = max(made, key=lambda s: (s.silhouette, -s.k))
    return best, made


def nearest_center(df: DataFrame, vector: str, centers: DataFrame) -> DataFrame:
    """Each row with the closest of a few given centres and its squared distance.

    ``centers`` has columns cluster_id and center, one row per cluster; they travel as one array in
    a scalar subquery. Equally close: smallest id.
    """
    packed = centers.agg(F.sort_array(F.collect_list(F.struct("cluster_id", "center")))).scalar()

    def measured(c: Column) -> Column:
        gaps = F.zip_with(vector, c["center"], lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
        total = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)
        return F.struct(total.alias("distance"), c["cluster_id"].alias("cluster_id"))

    nearest = df.withColumn("_centers", packed)
    nearest = nearest.withColumn("_near", F.array_min(F.transform("_centers", measured)))
    return nearest.withColumns(
        {"cluster_id": F.col("_near.cluster_id"), "squared_distance": F.col("_near.distance")}
    ).drop("_near", "_centers")


def cluster_profile(labelled: DataFrame, features: list[str]) -> DataFrame:
    """Mean, population deviation and row count per cluster and feature, in long form. Means are over
    decimals, whose sums do not depend on the order of rows."""
    stats = [
        F.expr(f"struct(cast(avg(cast({f} AS DECIMAL(18,8))) AS DOUBLE) AS mean, stddev_pop({f}) AS std) AS {f}")
        for f in features
    ]
    wide = labelled.groupBy("cluster_id").agg(F.count("*").alias("n"), *stats)
    rows = ", ".join(f"struct('{f}' AS feature, {f}.mean AS mean, coalesce({f}.std, 0D) AS std)" for f in features)
    return wide.selectExpr("cluster_id", "n", f"inline(array({rows}))").select("cluster_id", "feature", "mean", "std", "n")


def pivot_profile(profile: DataFrame, features: list[str]) -> DataFrame:
    """One row per cluster of the newest run, with the mean of each feature."""
    newest = profile.agg(F.max("created_at")).scalar()
    rows = profile.filter(F.col("created_at") == newest)
    return rows.groupBy("cluster_id").pivot("feature", features).agg(F.first("mean"))
