"""Keyed writes without merge support from the table format.

Source rows are reduced per key with max_by / min_by, combined before the shuffle, so a key with very
many copies costs one row per task; then each key meets the target once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pack(columns: list[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def _reduce(df: DataFrame, keys: list[str], last: list[str], first: list[str], order: Column) -> DataFrame:
    """Per key the newest value of the ``last`` columns and the oldest of the ``first`` columns."""
    packs = []
    if last:
        packs.append(F.max_by(_pack(last), order).alias("_last"))
    if first:
        packs.append(F.min_by(_pack(first), order).alias("_first"))
    if not packs:
        return df.select(*keys).distinct()
    reduced = df.groupBy(*keys).agg(*packs)
    columns = [F.col(k) for k in keys]
    columns += [F.col(f"_last.`{c}`").alias(c) for c in last]
    columns += [F.col(f"_first.`{c}`").alias(c) for c in first]
    return reduced.select(columns)


def dedupe_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that comes last in the given order."""
    rest = [c for c in df.columns if c not in keys]
    return _reduce(df, keys, rest, [], _pack(order)).select(df.columns)


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str], update: list[str] | None = None
) -> DataFrame:
    """Insert source rows; on a key clash overwrite only the ``update`` columns.

    Source rows apply in the given order. Columns of the target that are not listed keep the value
    they had first.
    """
    columns = target.columns
    update = [c for c in source.columns if c in columns and c not in keys] if update is None else update
    keep = [c for c in columns if c not in keys and c not in update]
    return _merge(target, source, keys, order, update, keep)


def replace(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Insert source rows; on a key clash the whole old row goes, so columns that the source lacks
    end as NULL."""
    return _merge(target, source, keys, order, [c for c in target.columns if c not in keys], [])


def _merge(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str], last: list[str], first: list[str]
) -> DataFrame:
    """The target, whose keys are unique, joined with one row per key of the source: the target's rows
    are neither grouped nor packed. NULL keys are equal."""
    present = set(source.columns)
    types = {f.name: f.dataType for f in target.schema.fields}
    fresh = source.select(
        *[(F.col(f"`{c}`") if c in present else F.lit(None)).cast(types[c]).alias(c) for c in target.columns],
        _pack(order).alias("_order"),
    )
    new = _reduce(fresh, keys, last, first, F.col("_order")).withColumn("_new", F.lit(True)).alias("new")
    old = target.withColumn("_old", F.lit(True)).alias("old")
    same = reduce(lambda a, b: a & b, (F.col(f"old.`{k}`").eqNullSafe(F.col(f"new.`{k}`")) for k in keys))

    def side(column: str) -> Column:
        mine, theirs = F.col(f"old.`{column}`"), F.col(f"new.`{column}`")
        prefer_new = F.col("_new").isNotNull() if column in last else F.col("_old").isNull()
        return F.when(prefer_new, theirs).otherwise(mine).alias(column)

    return old.join(new, same, "full_outer").select([side(c) for c in target.columns])


def backfill(df: DataFrame, column: str, value: Column, where: Column) -> DataFrame:
    """Set a column where the condition holds and the column is still NULL."""
    return df.withColumn(column, F.when(where & F.col(column).isNull(), value).otherwise(F.col(column)))
