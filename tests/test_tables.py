"""Queries over plain tables on made-up rows."""

import functools
import itertools
import operator

import duckdb

from locusframe.plans import catalog


def test_hc_filter_is_the_same_in_any_order(spark, tmp_path):
    # means of exactly three hundredths, some of which fall short of it when added up as doubles
    taxes = sorted(set(itertools.permutations((0.01, 0.01, 0.04, 0.06))))
    low = [(0.03, 0.03, 0.03, 0.02)]
    rows = [(k, x, 0.05) for k, t in enumerate(taxes + low) for x in t]
    assert any(functools.reduce(operator.add, t) / 4 < 0.03 for t in taxes)
    path = str(tmp_path / "lineitem.parquet")
    spark.createDataFrame(rows, "l_orderkey long, l_tax double, l_discount double").coalesce(1).write.parquet(path)
    expected = [(k, 4, 0.03, 0.05) for k in range(len(taxes))]
    got = catalog.queries()["hc_filter"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == expected
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(duck.sql(catalog.oracle_sql()["hc_filter"]).fetchall()) == expected
