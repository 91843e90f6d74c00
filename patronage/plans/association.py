"""Association tests between the dominant categories of shop months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..functions.numbers import first_largest
from ..operators.crosstab import association, pair_counts
from ..schemas import AUD_COLS, AUDIENCES
from .features import dominant_age

# The tests by name.
TESTS = {
    "age_bucket~aud_bucket": ("age_bucket", "aud_bucket"),
    "age_bucket~cancel_high": ("age_bucket", "cancel_high"),
    "aud_bucket~delivery_high": ("aud_bucket", "delivery_high"),
}


def dataset(age_buckets: DataFrame, aud_buckets: DataFrame, flags: DataFrame) -> DataFrame:
    """Both buckets and the flags of each shop month. The buckets come from the age mix row by row,
    so the age mix itself need not be joined again."""
    both = age_buckets.join(aud_buckets, ["mct_id", "ym"]).join(flags, ["mct_id", "ym"], "left")
    return both.select("mct_id", "ym", "age_bucket", "aud_bucket", "cancel_high", "delivery_high")


def dataset_from_features(rows: DataFrame) -> DataFrame:
    """The same rows out of the wide feature rows: both buckets and the flags in one projection."""
    return rows.select(
        "mct_id",
        "ym",
        dominant_age().alias("age_bucket"),
        first_largest(AUDIENCES, AUD_COLS).alias("aud_bucket"),
        "cancel_high",
        "delivery_high",
    )


def run_tests(rows: DataFrame, tests: dict[str, tuple[str, str]] = TESTS) -> DataFrame:
    return association(pair_counts(rows, tests))


def run(tables, run_ts: dt.datetime) -> None:
    """Append this run's tests to the stored history."""
    rows = dataset(tables.read("fx_age_bucket"), tables.read("fx_aud_bucket"), tables.read("fx_perf_flags"))
    tables.append("mat_assoc", run_tests(rows), run_ts)
