"""Every registered query runs; every one with SQL gives the rows DuckDB gives."""

import pytest
from compare import compare, duck
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def no_all_pairs_joins(monkeypatch):
    """Frames that a query writes on its way must not join all pairs either."""
    write = DataFrameWriter.parquet

    def checked(self, *args, **kwargs):
        plan = _plan(self._df)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", checked)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = _plan(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
