"""Contingency tables in long form and the tests on them.

Counts combine before the shuffle, so only (category, category) pairs travel. An empty cell adds its
expectation e to the chi-square sum, and all expectations add up to n, so the sum over the cells that
occur is enough and no table of all category pairs is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import chi_square_tail, cramers_v


def pair_counts(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Counts per (pair_name, row_cat, col_cat) of several column pairs, off one scan. Rows with a
    missing value leave only the pairs that use it."""
    sides = [
        F.struct(
            F.lit(name).alias("pair_name"),
            F.col(a).cast("string").alias("row_cat"),
            F.col(b).cast("string").alias("col_cat"),
        )
        for name, (a, b) in pairs.items()
    ]
    long = df.select(F.inline(F.array(*sides))).dropna(subset=["row_cat", "col_cat"])
    return long.groupBy("pair_name", "row_cat", "col_cat").agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, row: str, col: str, categories: list[str]) -> DataFrame:
    """Long contingency table with 0 for absent cells, over the categories that occur. ``categories`` is
    the closed list of what the column can hold; a value outside of it is an error."""
    counts = pair_counts(df, {"": (row, col)}).drop("pair_name")
    strange = F.raise_error(F.concat(F.lit(f"{col} has a category that isn't listed: "), F.col("col_cat")))
    listed = counts.withColumn("col_cat", F.when(F.col("col_cat").isin(categories), F.col("col_cat")).otherwise(strange))
    wide = listed.groupBy("row_cat").pivot("col_cat", categories).agg(F.sum("n"))
    long = wide.unpivot("row_cat", categories, "col_cat", "n")
    seen = long.groupBy("col_cat").agg(F.max("n").alias("_most")).filter("_most IS NOT NULL").select("col_cat")
    return long.join(seen, "col_cat", "left_semi").select("row_cat", "col_cat", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def association(counts: DataFrame) -> DataFrame:
    """Chi-square, degrees of freedom, p and Cramer's V per pair.

    With one degree of freedom the continuity correction applies: each deviation shrinks by up to
    one half, and in a 2 x 2 table all four deviations are the same size.
    """
    per_row, per_col = W.partitionBy("pair_name", "row_cat"), W.partitionBy("pair_name", "col_cat")
    o, r, c, n = F.col("n"), F.col("r"), F.col("c"), F.col("total")
    cells = counts.withColumns(
        {
            "r": F.sum("n").over(per_row),
            "c": F.sum("n").over(per_col),
            "in_row": F.count("*").over(per_row),
            "in_col": F.count("*").over(per_col),
            "total": F.sum("n").over(W.partitionBy("pair_name")),
        }
    )
    expected = r * c / n.cast("double")
    summed = cells.groupBy("pair_name").agg(
        F.count_distinct("row_cat").alias("rows"),
        F.count_distinct("col_cat").alias("cols"),
        F.max("total").alias("n"),
        F.count("*").alias("_cells"),
        F.sum(F.pow(o - expected, 2) / expected).alias("_seen"),
        F.sum(expected).alias("_expected"),
        F.max(F.abs(o - expected)).alias("_deviation"),
        # a 2 x 2 table has the inverse expectations sum to n * (1/r1 + 1/r2) * (1/c1 + 1/c2)
        F.sum(1.0 / (r * F.col("in_row"))).alias("_per_row"),
        F.sum(1.0 / (c * F.col("in_col"))).alias("_per_col"),
    )
    dof = ((F.col("rows") - 1) * (F.col("cols") - 1)).cast("int")
    shrunk = F.col("_deviation") - F.least(F.lit(0.5), F.col("_deviation"))
    corrected = shrunk * shrunk * F.col("n") * F.col("_per_row") * F.col("_per_col")
    full = F.col("_cells") == F.col("rows") * F.col("cols")
    plain = F.col("_seen") + F.when(full, 0.0).otherwise(F.col("n") - F.col("_expected"))
    chi2 = F.when(dof == 0, 0.0).when(dof == 1, corrected).otherwise(plain)
    tested = summed.withColumn("dof", dof).withColumn("chi2", chi2)
    return tested.select(
        "pair_name",
        "chi2",
        "dof",
        chi_square_tail(F.col("chi2"), F.col("dof")).alias("p_value"),
        cramers_v(F.col("chi2"), F.col("n"), F.col("rows"), F.col("cols")).alias("cramers_v"),
        "n",
    )
