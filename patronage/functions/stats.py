"""Statistics expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chi_square_tail(chi2: Column, dof: Column) -> Column:
    """P(X >= chi2) for a chi-square variable; 1 for no degrees of freedom.

    The upper regularised gamma function comes from the maths library on Spark's own class path,
    called through the built-in ``reflect``.
    """
    a = F.greatest(dof, F.lit(1)).cast("double") / 2.0
    x = F.greatest(chi2, F.lit(0.0)) / 2.0
    tail = F.reflect(
        F.lit("org.apache.commons.math3.special.Gamma"), F.lit("regularizedGammaQ"), a, F.coalesce(x, F.lit(0.0))
    ).cast("double")
    return F.when(dof > 0, tail).otherwise(1.0)


def cramers_v(chi2: Column, n: Column, rows: Column, cols: Column) -> Column:
    """Strength of an association in [0, 1]; 0 for a table with one row or column, or no counts."""
    width = F.least(rows, cols) - 1
    return F.when((width > 0) & (n > 0), F.sqrt(chi2 / n / width)).otherwise(0.0)
