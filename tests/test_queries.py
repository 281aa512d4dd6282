"""Every query with SQL against DuckDB on the smallest tables, with all values compared."""

import os

import duckdb
import pandas as pd
import pytest

from newsloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


def rows(frame, columns):
    value = lambda x: "" if pd.isna(x) else f"{x:.9g}" if isinstance(x, float) else str(x)
    return sorted(tuple(value(x) for x in r) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = duck.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 20
    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
