"""Decision-tree rules that explain a labelling."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions.numbers import fixed_text_sql
from . import tree

PATH_TYPE = "array<struct<feature:string,threshold:double,op:string>>"
SPLIT_BITS = 16


def _test_counts(sizes: dict[int, int], share: float) -> dict[int, int]:
    """Test rows per class: the total rounds up, classes get their whole part and the largest
    remainders one more."""
    total = ceil(sum(sizes.values()) * share)
    exact = {c: n * total / sum(sizes.values()) for c, n in sizes.items()}
    counts = {c: floor(e) for c, e in exact.items()}
    by_rest = sorted(exact, key=lambda c: (counts[c] - exact[c], c))
    for c in by_rest[: total - sum(counts.values())]:
        counts[c] += 1
    return counts


def stratified_split(
    df: DataFrame, label: str, keys: list[str], test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the exact share of each class in the test part.

    The test part of a class is its rows with the smallest hashes. The cut is found from a histogram
    of hash prefixes, and only the rows of the bucket that holds it are ranked, so no class is ever
    sorted as a whole. Driver values are one count and one cut per class and bucket.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys, F.lit(seed)))
    bucket = F.shiftright("_hash", 64 - SPLIT_BITS)
    histogram = hashed.groupBy(F.col(label).alias("label"), bucket.alias("bucket")).agg(F.count("*").alias("n"))
    sizes = {r["label"]: r["n"] for r in histogram.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    wanted = _test_counts(sizes, test_share)

    up_to = F.sum("n").over(W.partitionBy("label").orderBy("bucket"))
    need = F.element_at(F.create_map(*[F.lit(v) for pair in wanted.items() for v in pair]), F.col("label"))
    cuts = (
        histogram.withColumns({"up_to": up_to, "need": need})
        .filter((F.col("up_to") >= F.col("need")) & (F.col("up_to") - F.col("n") < F.col("need")))
        .select("label", "bucket", (F.col("need") - F.col("up_to") + F.col("n")).alias("rank"))
        .collect()
    )
    place = F.struct("_hash", *keys)
    none = F.lit(False)
    if not cuts:
        return df, df.filter(none)
    in_cut, rank_of = none, F.lit(None).cast("long")
    for c in cuts:
        here = (F.col(label) == c["label"]) & (bucket == c["bucket"])
        in_cut = in_cut | here
        rank_of = F.when(here, F.lit(c["rank"])).otherwise(rank_of)
    ranked = hashed.filter(in_cut).select(
        F.col(label).alias("label"),
        place.alias("place"),
        rank_of.alias("wanted"),
        F.row_number().over(W.partitionBy(label).orderBy("_hash", *keys)).alias("rank"),
    )
    last = ranked.filter(F.col("rank") == F.col("wanted")).select("label", "place").collect()
    in_test = none
    for row in last:
        values = [F.lit(v).alias(n) for n, v in row["place"].asDict().items()]
        in_test = in_test | ((F.col(label) == row["label"]) & (place <= F.struct(*values)))
    marked = hashed.withColumn("_test", F.coalesce(in_test, none))
    return (
        marked.filter(~F.col("_test")).drop("_hash", "_test"),
        marked.filter(F.col("_test")).drop("_hash", "_test"),
    )


@dataclass(frozen=True)
class Tree:
    """Leaves depth first, left first, with the training rows of each class."""

    features: list[str]
    leaves: list[tree.Node]
    classes: list[int]

    def majority(self, leaf: tree.Node) -> int | None:
        """The most frequent class of a leaf, the smallest of equals."""
        return self.classes[int(leaf.counts.argmax())] if self.classes else None

    def apply(self, df: DataFrame) -> DataFrame:
        """Rows with their leaf and predicted label; one expression over the row."""
        leaf, predicted = F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, node in enumerate(self.leaves):
            here = tree.meets(node.tests)
            leaf, predicted = F.when(here, i).otherwise(leaf), F.when(here, self.majority(node)).otherwise(predicted)
        return df.withColumns({"leaf": leaf, "predicted": predicted})

    @property
    def train_accuracy(self) -> float | None:
        n = sum(leaf.counts.sum() for leaf in self.leaves)
        return float(sum(leaf.counts.max() for leaf in self.leaves) / n) if n else None


def fit_tree(train: DataFrame, features: list[str], label: str, max_depth: int = 3, min_leaf: int = 50) -> Tree:
    """A tree over rows without missing features. Sibling leaves stay apart also where they predict the
    same class, so a class that leads everywhere still gets its rules."""
    root, classes = tree.grow(train, list(features), label, max_depth, min_leaf)
    return Tree(list(features), root.leaves(), classes)


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"))


def rule_text(path: str) -> Column:
    """``feature op threshold`` tests joined by AND."""
    test = f"concat_ws(' ', t.feature, t.op, {fixed_text_sql('t.threshold', 3)})"
    return F.expr(f"array_join(transform({path}, t -> {test}), ' AND ')")


def leaf_stats(rows: DataFrame, leaf: str, label: str) -> DataFrame:
    """Majority label, support and precision per leaf; a tie takes the smallest label."""
    counts = rows.groupBy(leaf, label).agg(F.count("*").alias("_n"))
    return counts.groupBy(leaf).agg(
        F.max_by(label, F.struct("_n", -F.col(label))).cast("int").alias("cluster_id"),
        F.sum("_n").alias("support"),
        (F.max("_n") / F.sum("_n")).alias("rule_precision"),
    )


def matching_rules(df: DataFrame, rules: DataFrame, features: list[str]) -> DataFrame:
    """Each row with the id of every rule whose tests it meets.

    ``rules`` has columns rule_id and path, one row per tree leaf; they travel as one array in a
    scalar subquery, so rows are only mapped.
    """
    packed = rules.agg(F.sort_array(F.collect_list(F.struct("rule_id", "path")))).scalar()
    values = F.create_map(*[part for f in features for part in (F.lit(f), F.col(f).cast("double"))])

    def met(test: Column) -> Column:
        value = F.col("_values")[test["feature"]]
        return F.when(test["op"] == "<=", value <= test["threshold"]).otherwise(value > test["threshold"])

    prepared = df.withColumns({"_values": values, "_rules": packed})
    fitting = F.filter("_rules", lambda r: F.forall(r["path"], met))
    out = prepared.withColumn("_rule", F.explode(fitting)).withColumn("rule_id", F.col("_rule.rule_id"))
    return out.drop("_values", "_rules", "_rule")


def extract_rules(fitted: Tree, spark: SparkSession, first_id: int = 1) -> DataFrame:
    """Rule rows of a tree, numbered in leaf order, with support and precision on the training rows.
    A tree that is only a root gives no rules."""
    values = [
        (
            first_id + i, i, len(leaf.tests), fitted.majority(leaf), int(leaf.counts.sum()),
            float(leaf.counts.max() / leaf.counts.sum()), fitted.train_accuracy, leaf.tests,
        )
        for i, leaf in enumerate(fitted.leaves)
        if leaf.tests
    ]
    schema = (
        "rule_id long, leaf int, depth int, cluster_id int, support long, rule_precision double, train_acc double,"
        f" path {PATH_TYPE}"
    )
    rules = spark.createDataFrame(values, T.StructType.fromDDL(schema))
    return rules.select(
        "rule_id", "leaf", "depth", "cluster_id", F.substring(rule_text("path"), 1, 1024).alias("rule_text"),
        "support", "rule_precision", "train_acc", "path",
    )


def assign_rules(fitted: Tree, rules: DataFrame, rows: DataFrame) -> DataFrame:
    """Every row with the rule of its leaf; rows of leaves without a rule drop out."""
    leaves = F.broadcast(rules.select("leaf", "rule_id", F.col("cluster_id").alias("rule_cluster")))
    return fitted.apply(rows).join(leaves, "leaf")
