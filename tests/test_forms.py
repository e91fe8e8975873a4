"""Comparison of hits: batches at once against the column functions."""

import random

from pyspark.sql import functions as F

from locusframe.functions import forms


def _blocks(r):
    return sorted((s, s + r.choice((0, 4, 9, 14))) for s in (5 * r.randrange(1, 9) for _ in range(r.randrange(0, 5))))


def test_compared_batches_as_column_functions(spark):
    r = random.Random(3)
    rows = [(i, _blocks(r), _blocks(r)) for i in range(400)]
    pairs = spark.createDataFrame(rows, "i long, a array<struct<s: long, e: long>>, b array<struct<s: long, e: long>>")
    got = {x.i: (x.sx, x.sy, x.xy, x.yx) for x in forms.compared(pairs, ["i"]).collect()}
    a, b = F.col("a"), F.col("b")
    sx, sy = forms.shadows(a, b)
    expected = pairs.select("i", sx.alias("sx"), sy.alias("sy"), forms.codes(a, b).alias("xy"), forms.codes(b, a).alias("yx"))
    assert got == {x.i: (x.sx, x.sy, x.xy, x.yx) for x in expected.collect()}


def test_blocks_without_an_end_meet_nothing(spark):
    pairs = spark.createDataFrame([(1, [(None, None), (3, 9)], [(3, 9), (20, None)])], "i long, a array<struct<s: long, e: long>>, b array<struct<s: long, e: long>>")
    x = forms.compared(pairs, ["i"]).head()
    assert (x.xy, x.yx) == ("01", "10")
    assert sorted(x.sx) == sorted("001")


def test_queries_compare_in_batches(spark):
    from locusframe.plans import catalog

    for name in ("shadow_codes", "same_forms", "redundant_pairs", "redundant_forms", "distinct_forms"):
        plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "aggregate(" not in plan, name
