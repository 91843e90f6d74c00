"""Tree rules that explain the latest segments, and the rule each shop falls under."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clustering import fill_missing
from ..operators.keyed import dedupe_last
from ..operators.ranking import latest_k
from ..operators.rules import accuracy, assign_rules, extract_rules, fit_tree, stratified_split
from ..schemas import FEATURES
from ..session import cut_lineage


@dataclass(frozen=True)
class RuleTables:
    rules: DataFrame
    assigned: DataFrame
    train_accuracy: float
    test_accuracy: float


def labelled_rows(clusters: DataFrame, features: DataFrame, latest_only: bool = False) -> DataFrame:
    """All feature rows of the shops in the latest run, with the shop's cluster; a shop with
    several months has several rows, of which `latest_only` keeps the month that was labelled."""
    newest = clusters.filter(F.col("k") == latest_k(clusters).scalar())
    on = ["mct_id", "ym"] if latest_only else ["mct_id"]
    rows = newest.select(*on, "cluster_id", "k").join(features.select("mct_id", "ym", *FEATURES), on)
    return fill_missing(rows.select("mct_id", "cluster_id", "k", "ym", *FEATURES), FEATURES)


def explain(
    clusters: DataFrame,
    features: DataFrame,
    run_ts: dt.datetime,
    first_rule_id: int = 1,
    max_depth: int = 3,
    min_leaf: int = 50,
    test_share: float = 0.2,
    latest_only: bool = False,
) -> RuleTables:
    """Fit on the training part; support and precision count training rows, assignment covers all.

    By default every month of a shop carries the cluster of its newest month. `latest_only` fits on
    and assigns the months that were labelled themselves.
    """
    rows = cut_lineage(labelled_rows(clusters, features, latest_only))
    train, test = stratified_split(rows, "cluster_id", ["mct_id", "ym"], test_share)
    tree = fit_tree(cut_lineage(train.select("cluster_id", *FEATURES)), FEATURES, "cluster_id", max_depth, min_leaf)
    test_accuracy = accuracy(tree.apply(test), "cluster_id", "predicted").first()["accuracy"]
    rules = extract_rules(tree, rows.sparkSession, first_rule_id)
    k = rows.agg(F.max("k")).scalar()
    stamp = F.lit(run_ts).alias("created_at")
    assigned = dedupe_last(
        assign_rules(tree, rules, rows).select("mct_id", "k", "ym", "rule_id", F.col("rule_cluster").alias("cluster_id")),
        ["mct_id", "k"],
        ["ym", "rule_id"],
    )
    return RuleTables(
        rules=rules.select("rule_id", k.alias("k"), *[c for c in rules.columns if c != "rule_id"], stamp),
        assigned=assigned.select("mct_id", "k", "rule_id", "cluster_id", stamp),
        train_accuracy=tree.train_accuracy,
        test_accuracy=test_accuracy,
    )


def run(tables, features: DataFrame, run_ts: dt.datetime, **options) -> RuleTables:
    """Explain the stored segments; rules append to the history, assignments upsert."""
    newest = tables.read("mat_tree_rules", history=True).agg(F.max("rule_id")).first()[0]
    made = explain(tables.read("mat_store_cluster"), features, run_ts, (newest or 0) + 1, **options)
    tables.append("mat_tree_rules", made.rules, run_ts)
    tables.upsert("mat_store_rule_assign", made.assigned, ["rule_id"], update=["rule_id", "cluster_id"])
    return made
