"""Numeric expressions: shares, flags, rounding and number texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL = -999999.9  # fixed value: "not published" in the source tables


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share(percent: str) -> Column:
    """A 0-100 percent column as 0-1. The value is held to its range first, so the sentinel ends as
    0, and so does a missing value."""
    return F.expr(f"coalesce(least(greatest(cast({percent} AS DOUBLE), 0D), 100D) / 100D, 0D)")


def part_of(part: str, total: str) -> Column:
    """part / total to four decimals by way of six; 0 for a missing or zero total."""
    return F.expr(f"cast(round(coalesce({part} / nullif({total}, 0D), 0D), 6) AS DECIMAL(6,4))")


def mentions_high(text: str | Column) -> Column:
    """1 where the band text says high, in either language, else 0."""
    return F.lower(F.coalesce(_col(text), F.lit(""))).rlike("상|high").cast("int")


def above_half(value: str | Column) -> Column:
    """1 where the value is published and above 0.5, else 0."""
    known = F.nullif(_col(value).cast("double"), F.lit(SENTINEL))
    return F.when(known > 0.5, 1).otherwise(0)


def first_largest(names: list[str], columns: list[str]) -> Column:
    """Name of the largest column; the earlier name wins a tie, a missing value counts as 0."""
    values = ", ".join(f"coalesce(cast({c} AS DOUBLE), 0D)" for c in columns)
    labels = ", ".join(f"'{n}'" for n in names)
    return F.expr(f"element_at(array({labels}), cast(array_position(array({values}), array_max(array({values}))) AS INT))")


def half_even_sql(x: str, digits: int) -> str:
    """SQL text that rounds the double named ``x`` by its exact binary value, ties to even.

    ``round`` works on the shortest decimal text (0.345 counts as a tie), which differs from the
    binary value that ``%.2f`` style formatting and IEEE rounding go by. Here the product with
    10**digits is split into a rounded part and its exact error, and both decide. The factor
    2**27 + 1 splits a double into two halves of 26 bits.
    """
    scale = f"{10**digits}D"
    high = f"({x} * 134217729D - ({x} * 134217729D - {x}))"
    error = f"(({high} * {scale} - {x} * {scale}) + ({x} - {high}) * {scale})"
    whole = f"cast(floor({x} * {scale}) AS DOUBLE)"
    beyond = f"(({x} * {scale} - {whole} - 0.5D) + {error})"
    up = f"if({beyond} > 0 OR ({beyond} = 0 AND pmod({whole}, 2D) = 1), 1D, 0D)"
    return f"(({whole} + {up}) / {scale})"


def fixed_text_sql(x: str, digits: int) -> str:
    """SQL text for the number text of the double named ``x`` with a fixed count of decimals."""
    return f"format_string('%.{digits}f', {half_even_sql(x, digits)})"


def round_half_even(column: str, digits: int) -> Column:
    return F.expr(half_even_sql(f"cast({column} AS DOUBLE)", digits))


def fixed_text(column: str, digits: int) -> Column:
    return F.expr(fixed_text_sql(f"cast({column} AS DOUBLE)", digits))


def percent_label(value: str | Column) -> Column:
    """Whole-percent label such as ``35%``."""
    return F.concat(F.rint(_col(value) / 0.01).cast("int").cast("string"), F.lit("%"))


def strength_band(value: str | Column) -> Column:
    """Band of a 0-1 score; each band includes its upper end."""
    v = _col(value)
    return F.when(v <= 0.50, "약함").when(v <= 0.75, "보통").when(v.isNotNull(), "강함")
