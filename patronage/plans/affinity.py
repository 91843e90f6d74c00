"""Affinity tables from wide CSV files to stored tables."""

from __future__ import annotations

from ..operators.affinity import load_affinity, replace_affinity
from ..sources.delimited import read_ordered_csv
from ..sources.tables import Tables


def run(tables: Tables, files: dict[str, str], version: str) -> None:
    """Load ``media``, ``interest`` and, where there is one, ``video``; rows of a version that is stored
    already are replaced key by key."""
    sheets = {kind: read_ordered_csv(tables.spark, path) for kind, path in files.items()}
    channels, keywords = load_affinity(sheets["media"], sheets["interest"], sheets.get("video"), version)
    for table, rows, item in (
        ("dim_age_affinity_media", channels, "channel"),
        ("dim_age_affinity_keyword", keywords, "keyword"),
    ):
        tables.write(table, replace_affinity(tables.read(table), rows, item))
