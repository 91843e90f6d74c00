"""Frames whose columns come from elsewhere, kept apart from an operator's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def aside(df: DataFrame, *kept: str) -> DataFrame:
    """All columns under names that no operator uses, but for those that it needs."""
    return df.toDF(*(c if c in kept else f"column {i}" for i, c in enumerate(df.columns)))


def restored(df: DataFrame, like: DataFrame, *kept: str) -> DataFrame:
    """The columns of `aside` under their own names and in their order, then `kept` ones of the operator."""
    own = [f"column {i}" if f"column {i}" in df.columns else c for i, c in enumerate(like.columns)]
    return df.select(*own, *kept).toDF(*like.columns, *kept)
