"""Registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from patronage.llm import queries as modules


def _modules():
    names = sorted(m.name for m in pkgutil.iter_modules(modules.__path__))
    return [importlib.import_module(f"{modules.__name__}.{name}") for name in names]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {m.NAME: m.query for m in _modules()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {m.NAME: m.SQL for m in _modules()} | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: sql for name, sql in found.items() if sql}
