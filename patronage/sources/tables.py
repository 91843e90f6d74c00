"""A folder of Parquet tables.

Every write goes to a new ``run=<id>`` folder and counts once its ``_SUCCESS`` marker is there, so a
job can read a table and replace it, and a job that dies half way leaves the old rows readable.

Keyed tables lie in parts: months, or buckets of the key where it has no month. A keyed write reads and
writes the parts that its rows fall into and no others; a part's newest run holds its rows. Runs that
write a whole table end in ``.all``. Runs of history tables lie in folders by run time and, where several
histories share a table, by what tells them apart, so the newest ones are found by their folders' names.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import replace as replace_rows
from ..operators.keyed import upsert as upsert_rows
from ..schemas import KEYS, SCHEMAS, conform, empty
from ..session import cut_lineage
from .delimited import lost, read_text_csv, typed

MONTHS = ("ym", "TA_YM")
#: Parts of a table whose key has no month. Stored tables depend on the number.
BUCKETS = 16
WHOLE = ".all"
#: History tables whose runs are told apart by one column besides their time.
RUN_GROUPS = {"mat_cluster_profile": "k", "mat_tree_rules": "k"}
RUN_TIME = "%Y%m%dT%H%M%S%f"


def month_of(table: str) -> str | None:
    """The column of a table's key that is a month."""
    return next((k for k in KEYS[table] if k in MONTHS), None)


def part_of(table: str) -> Column:
    """The part that a row belongs to, a function of its key that serves as a folder's name."""
    month = month_of(table)
    if month:
        return F.coalesce(F.regexp_replace(F.col(month).cast("string"), "[^0-9A-Za-z-]", "_"), F.lit("none"))
    return F.concat(F.lit("b"), F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in KEYS[table]]), F.lit(BUCKETS)))


class Tables:
    """``keep_runs`` is how many runs of a keyed table stay, the newest among them; all by default."""

    def __init__(self, spark: SparkSession, root: str, keep_runs: int | None = None):
        if keep_runs is not None and keep_runs < 1:
            raise ValueError("the newest run stays")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_runs = keep_runs

    def _files(self, path: str):
        """A Hadoop path and its file system."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self, path: str, prefix: str) -> list[str]:
        folder, fs = self._files(path)
        found = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(str(p) for p in found if p.getName().startswith(prefix))

    def _complete_runs(self, table: str) -> list[str]:
        runs = self._folders(f"{self.root}/{table}", "run=")
        return [r for r in runs if (lambda path, fs: fs.exists(path))(*self._files(f"{r}/_SUCCESS"))]

    def _states(self, table: str) -> list[dict[str, str]]:
        """After each complete run, the folder that holds each part; a run without parts is one by itself."""
        states, now = [], {}
        for run in self._complete_runs(table):
            parts = {p.rpartition("=")[2]: p for p in self._folders(run, "_part=")}
            now = {**({} if run.endswith(WHOLE) or not parts else now), **(parts or {"": run})}
            states.append(now)
        return states

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        if not folders:
            return empty(self.spark, table)
        found = self.spark.read.schema(SCHEMAS[table]).option("basePath", f"{self.root}/{table}").parquet(*folders)
        return found.select(SCHEMAS[table].names)

    def _state(self, table: str) -> dict[str, str]:
        states = self._states(table)
        return states[-1] if states else {}

    def read(self, table: str, history: bool = False, months: list[str] | None = None) -> DataFrame:
        """The newest state of a table, or with ``history`` the rows of all runs. Of a table whose key has
        a month, ``months`` reads the folders of these only."""
        if history:
            return self._read(table, self._complete_runs(table))
        now = self._state(table)
        if months is None:
            return self._read(table, sorted(now.values()))
        column = month_of(table)
        parts = {re.sub("[^0-9A-Za-z-]", "_", m) for m in months}
        found = self._read(table, sorted(f for part, f in now.items() if part in parts or not part))
        return found.filter(F.col(column).isin(months))

    def newest(self, table: str) -> DataFrame:
        """The rows of the newest run of each group of a history table: a filter on folders, whatever the
        length of the history."""
        runs, latest = self._complete_runs(table), {}
        if not runs:
            return empty(self.spark, table)
        for run in runs:
            for moment in self._folders(run, "_run_at="):
                for of in self._folders(moment, "_group="):
                    key, at = of.rpartition("=")[2], moment.rpartition("=")[2]
                    latest[key] = max(latest.get(key, at), at)
        schema = T.StructType([*SCHEMAS[table], T.StructField("_run_at", T.StringType()), T.StructField("_group", T.StringType())])
        wanted = F.lit(False)
        for key, at in latest.items():  # one a group
            wanted = wanted | ((F.col("_group") == key) & (F.col("_run_at") == at))
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*runs).filter(wanted)
        return found.select(SCHEMAS[table].names)

    def _write(self, table: str, df: DataFrame, whole: bool) -> None:
        run = dt.datetime.now(dt.timezone.utc).strftime(RUN_TIME)
        rows = conform(df, table).withColumn("_part", part_of(table))
        # few files a part, and a hot part is split by its size
        dealt = rows.hint("rebalance", "_part")
        dealt.write.partitionBy("_part").parquet(f"{self.root}/{table}/run={run}{WHOLE if whole else ''}")

    def write(self, table: str, df: DataFrame) -> None:
        """The new state of a keyed table."""
        self._write(table, df, whole=True)

    def recreate(self, *tables: str) -> None:
        """Empty tables with their declared columns; all of them if none is named."""
        for table in tables or SCHEMAS:
            self.write(table, empty(self.spark, table))

    def upsert(self, table: str, df: DataFrame, order: list[str], update: list[str] | None = None) -> None:
        self._merge(table, df, lambda old, new: upsert_rows(old, new, KEYS[table], order, update))

    def replace(self, table: str, df: DataFrame, order: list[str]) -> None:
        self._merge(table, df, lambda old, new: replace_rows(old, new, KEYS[table], order))

    def overwrite_months(self, table: str, df: DataFrame) -> None:
        """The months that the rows fall into hold these rows and no others from now on."""
        self._write(table, df, whole=False)
        self._drop_old(table)

    def _merge(self, table: str, df: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Write the parts that the rows fall into, with these rows merged in."""
        source = cut_lineage(df.withColumn("_part", part_of(table)))
        touched = {r[0] for r in source.select("_part").distinct().collect()}  # months or buckets
        now = self._state(table)
        whole = "" in now  # rows that don't lie in parts yet
        old = self._read(table, sorted(p for part, p in now.items() if whole or part in touched))
        if touched:
            self._write(table, merged(old, source.drop("_part")), whole=whole)
        self._drop_old(table)

    def _drop_old(self, table: str) -> None:
        """Delete what none of the states to keep needs."""
        if self.keep_runs is None:
            return
        needed = {p for state in self._states(table)[-self.keep_runs :] for p in state.values()}
        for run in self._complete_runs(table):
            parts = self._folders(run, "_part=")
            unused = [p for p in parts if p not in needed]
            for folder in [run] if run not in needed and len(unused) == len(parts) else unused:
                path, fs = self._files(folder)
                fs.delete(path, True)

    def append(self, table: str, df: DataFrame, created_at: dt.datetime) -> None:
        """History rows with the run's timestamp."""
        rows = conform(df.withColumn("created_at", F.lit(created_at)), table)
        group = F.col(RUN_GROUPS[table]).cast("string") if table in RUN_GROUPS else F.lit("all")
        folders = {"_run_at": F.lit(created_at.strftime(RUN_TIME)), "_group": F.coalesce(group, F.lit("none"))}
        run = dt.datetime.now(dt.timezone.utc).strftime(RUN_TIME)
        rows.withColumns(folders).write.partitionBy(*folders).parquet(f"{self.root}/{table}/run={run}")

    def load_staging(self, store_csv: str, perf_csv: str, demo_csv: str, multiline: bool = False) -> dict[str, dict[str, int]]:
        """Full reload of the three staging tables from CSV files. ``multiline`` reads line breaks inside
        quotes, at the price of one task per file. Returns by table and column how many cells did not fit
        the declared type and became NULL, counted by the pass that writes."""
        found = {}
        for table, path in (("stg_store", store_csv), ("stg_perf", perf_csv), ("stg_demo", demo_csv)):
            counts = Observation()
            texts = read_text_csv(self.spark, path, multiline)
            cells = lost(texts, SCHEMAS[table])
            watched = texts.observe(counts, F.count("*").alias("rows"), *[c.alias(n) for n, c in cells.items()])
            self.write(table, typed(watched, SCHEMAS[table]))
            found[table] = {n: counts.get[n] for n in cells}
        return found
