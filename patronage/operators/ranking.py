"""Best-of and top-n rows per group, and the newest run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: list[str], value: str, name: str, n: int) -> DataFrame:
    """The n largest values per group with their rank; equal values in name order. Spark limits
    each partition to n rows per group before the shuffle."""
    order = W.partitionBy(*group).orderBy(F.col(value).desc(), F.col(name).asc())
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def best_rules(rules: DataFrame) -> DataFrame:
    """Per (k, cluster_id) the rule with the best precision, then support, then the shortest, then
    the oldest."""
    rest = [c for c in rules.columns if c not in ("k", "cluster_id")]
    worth = F.struct(F.col("rule_precision"), F.col("support"), -F.col("depth"), -F.col("rule_id"))
    best = rules.groupBy("k", "cluster_id").agg(F.max_by(F.struct(*rest), worth).alias("_best"))
    return best.select("k", "cluster_id", "_best.*")


def newest_runs(rules: DataFrame) -> DataFrame:
    """The rows of the newest run of each k: cluster 2 of an older run is another cluster. A run has a
    rule for each leaf of a small tree, so the history of a k is no large window."""
    newest = rules.withColumn("_newest", F.max("created_at").over(W.partitionBy("k")))
    return newest.filter(F.col("created_at") == F.col("_newest")).drop("_newest")


def latest_k(clusters: DataFrame) -> DataFrame:
    """One row with the k of the newest run; of runs at the same moment the larger k."""
    return clusters.agg(F.max(F.struct("created_at", "k")).alias("_newest")).select(F.col("_newest.k").alias("k"))
