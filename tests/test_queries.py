"""Every registered query of the interval engine against its DuckDB counterpart on the smallest tables."""

import glob
import os

import duckdb
import pytest

from locusframe.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(names, values):
    return sorted((tuple(round(r[n], 6) if isinstance(r[n], float) else r[n] for n in names) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == names
    expected = [dict(zip(relation.columns, r, strict=True)) for r in relation.fetchall()]
    assert rows(names, df.collect()) == rows(names, expected)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
