"""Registered queries against DuckDB: same columns, same rows in any order."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a frame and the SQL result; an empty list if there are none."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    want = _rows(names, result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return [f"{len(got)} rows against {len(want)}"]
    types = [(type(a), type(b)) for g, w in zip(got, want) for a, b in zip(g, w) if a is not None and b is not None]
    odd = {t for t in types if t[0] is not t[1]}
    diffs = [f"{g} against {w}" for g, w in zip(got, want) if g != w]
    return ([f"types {odd}"] if odd else []) + ([f"{len(diffs)} of {len(got)} rows differ"] + diffs[:3] if diffs else [])


if __name__ == "__main__":
    import __spark_entry__ as entry
    from patronage.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    if os.environ.get("PLAIN_SESSION"):  # what a caller without any of our settings has
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").getOrCreate()
    else:
        spark = build_session("local[8]", 8, spark__driver__memory="12g", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = duck(sf_dir), entry.queries(), entry.oracle_sql()
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = compare(df, con, oracles[name]) if name in oracles else [f"rows only: {df.count()}"]
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        print(f"{name:28s} {time.time() - start:6.1f}s {'ok' if not found else found}", flush=True)
