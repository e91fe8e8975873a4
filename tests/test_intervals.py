import random

import pytest
from pyspark.sql import functions as F

from locusframe import shared
from locusframe.operators import clusters, intervals, scores, selection


def pieces(spark, rows, flank=0):
    df = spark.createDataFrame([("c", s, e) for s, e in rows], "k string, s long, e long")
    return sorted((r.s, r.e) for r in intervals.merge(df, ["k"], flank, block=8).collect())


@pytest.mark.parametrize(
    ("rows", "flank", "expected"),
    [([(1, 5), (6, 9)], 0, [(1, 9)]), ([(1, 5), (7, 9)], 0, [(1, 5), (7, 9)]), ([(10, 15), (18, 20)], 1, [(9, 21)]), ([(2, 5)], 10, [(1, 15)])],
)
def test_merge_cases(spark, rows, flank, expected):
    assert pieces(spark, rows, flank) == expected


def test_merge_against_a_sweep(spark):
    draw = random.Random(3)
    rows = [(s, s + draw.randrange(9)) for s in (draw.randrange(1, 150) for _ in range(60))]
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    assert pieces(spark, rows) == out
    assert pieces(spark, out) == out


def test_classes(spark):
    b = [(10, 20), (5, 20), (15, 20), (10, 30), (10, 15), (5, 30), (12, 18), (15, 30), (5, 15), (30, 40), (20, 10)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(b)], "i int, s long, e long")
    got = df.select("i", intervals.classify(F.lit(10), F.lit(20), F.col("s"), F.col("e")).alias("c")).orderBy("i").collect()
    assert "".join(r.c for r in got) == "1BAbaIiZz0R"


def test_joins_against_all_pairs(spark):
    draw = random.Random(5)
    make = lambda n: [(i, "c", s, s + draw.randrange(200)) for i, s in enumerate(draw.randrange(1, 2000) for _ in range(n))]
    a, b = make(60), make(60)
    left = spark.createDataFrame(a, "i int, k string, s long, e long")
    right = spark.createDataFrame(b, "j int, k string, s long, e long")
    for flank in (0, 7):
        expected = sorted((i, j) for i, _, s, e in a for j, _, p, q in b if s - flank <= q and p <= e + flank)
        assert sorted((r.i, r.j) for r in intervals.overlap_join(left, right, ["k"], flank).collect()) == expected
        anti = selection.unsupported(left, right.drop("j"), ["k"], flank)
        assert sorted(r.i for r in anti.collect()) == sorted({x[0] for x in a} - {i for i, _ in expected})


def test_agreement(spark):
    one = lambda s, e: spark.createDataFrame([("c", s, e)], "k string, s long, e long")
    r = scores.agreement(one(6, 15), one(1, 10), ["k"]).head()
    assert (r.sn, r.sp, r.aed) == (0.5, 0.5, 0.5)
    assert scores.agreement(one(6, 15), one(6, 15), ["k"]).head().aed == 0
    assert scores.agreement(one(6, 15), one(50, 60), ["k"]).head().aed == 1


def test_greedy(spark):
    df = spark.createDataFrame([("c", "A", 1, 1, 10), ("c", "B", 2, 8, 20), ("c", "C", 3, 15, 30)], "k string, id string, r int, s long, e long")
    assert sorted(r.id for r in selection.greedy(df, ["k"], [F.col("r")], "id").collect()) == ["A", "C"]


def test_greedy_across_blocks(spark):
    """Components that lie in one block, reach over several or end at a block's border; rows are shuffled once where none reaches over, and ids are made behind that."""
    r = random.Random(8)
    for block, longest in ((16, 40), (16, 3), (1 << 12, 40)):
        rows = [(k, n, s, s + r.randrange(longest)) for k in (1, 2, 3) for n, s in enumerate(r.randrange(1, 400 * k) for _ in range(90))]
        rows += [(4, 1, 1, 15), (4, 2, 15, 16), (4, 3, 16, 31), (4, 4, 32, 33), (4, 5, 31, 100), (4, 6, 100, 101)]
        want = set()
        for key in (1, 2, 3, 4):
            kept = []
            for k, n, s, e in sorted((x for x in rows if x[0] == key), key=lambda x: (-(x[1] % 7), f"{x[0]}-{x[1]}")):
                if all(e < p or q < s for p, q in kept):
                    kept.append((s, e))
                    want.add((k, f"{k}-{n}", s, e))
        df = spark.createDataFrame([*rows, (5, 1, None, 3), (None, 1, 2, 3)], "k long, n long, s long, e long").withColumn("m", F.col("n") % 7)
        got = selection.greedy(df, ["k"], [F.desc("m"), F.col("id")], "id", made=F.concat_ws("-", "k", "n"), block=block, n=len(rows))
        found = [tuple(x) for x in got.collect()]
        assert len(found) == len(want) and set(found) == want
        if block > 400:
            plan = got._jdf.queryExecution().optimizedPlan().toString() + got._jdf.queryExecution().sparkPlan().toString()
            assert "Join" not in plan and got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_components_in_groups(spark):
    rows = [("g", 1, 1, 5), ("g", 1, 50, 60), ("g", 2, 4, 9), ("g", 3, 20, 30), ("g", 4, 55, 58), ("h", 9, 1, 2)]
    df = spark.createDataFrame(rows, "k string, n long, s long, e long")
    got = {(r.k, r.n): r.component for r in clusters.components_in_groups(df, ["k"], "n").collect()}
    assert got == {("g", 1): 1, ("g", 2): 1, ("g", 3): 3, ("g", 4): 1, ("h", 9): 9}


def test_best_score(spark):
    df = spark.createDataFrame([("12.5", None, None), ("x", "7", None), (None, None, "1e-3"), (None, None, "2"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(clusters.best_score(F.col("a"), F.col("b"), F.col("c"))).collect()] == [12.5, 7.0, 9990.0, 0.0, 0.0]


@pytest.mark.parametrize("bins", [intervals.BINS, intervals.TIERS, (64, 1024, 1 << 14)])
def test_overlaps_of_all_lengths(spark, bins):
    """Short and very long intervals on both sides."""
    import random

    r = random.Random(2)
    lengths = (1, 5, 63, 64, 65, 200, 8_000, 9_000, 300_000)
    make = lambda n, seed: [(i, i % 2, s, s + r.choice(lengths) - 1) for i in range(n) for s in [r.randrange(1, 40_000)]]
    a, b = make(150, 1) + [(900, 0, 1, 10_000_000)], make(150, 2) + [(901, 0, 5_000_000, 5_000_001), (902, 1, 3, 10_000_000)]
    left, right = spark.createDataFrame(a, "x long, k long, s long, e long"), spark.createDataFrame(b, "y long, k long, s long, e long")
    for flank in (0, 7):
        want = sorted((x, y) for x, k, s, e in a for y, j, p, q in b if k == j and s - flank <= q and p <= e + flank)
        joined = intervals.overlap_join(left, right, ["k"], flank, bin_sizes=bins)
        got = [(v.x, v.y) for v in joined.collect()]
        assert sorted(got) == want
        assert {v.x for v in intervals.overlap_join(left, right, ["k"], flank, "left_semi", bins).collect()} == {x for x, _ in want}
        assert {v.x for v in intervals.overlap_join(left, right, ["k"], flank, "left_anti", bins).collect()} == {x for x, *_ in a} - {x for x, _ in want}


def test_rows_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(shared, "TASK_ROWS", 10)
    df = spark.range(200).select((F.col("id") % 50).alias("k"), (F.col("id") * 7 % 90 + 1).alias("s"), (F.col("id") * 7 % 90 + 9).alias("e"))
    found = intervals.merge(df, ["k"], block=16, rows=200)
    assert found.rdd.getNumPartitions() == 20
    assert sorted(found.collect()) == sorted(intervals.merge(df, ["k"], block=16).collect())
    assert shared.dealt(df, ["k"], None).rdd.getNumPartitions() == shared.dealt(df, ["k"], 20).rdd.getNumPartitions() == df.rdd.getNumPartitions()


def test_merge_holds_no_groups(spark, capsys):
    intervals.merge(spark.createDataFrame([("c", 1, 5)], "k string, s long, e long"), ["k"]).explain()
    assert "Aggregate" not in capsys.readouterr().out


@pytest.mark.parametrize("block", [8, 1 << 12])
def test_coverage_against_bases(spark, block):
    draw = random.Random(5)
    sets = {n: [(draw.choice("xyz"), s, s + draw.randrange(-1, 20)) for s in (draw.randrange(1, 120) for _ in range(25))] for n in "abc"}
    found = intervals.coverage({n: spark.createDataFrame(rows, "k string, s long, e long") for n, rows in sets.items()}, ["k"], (("a", "b"), ("a", "c")), block)
    bases = {n: {k: {p for q, s, e in rows if q == k for p in range(s, e + 1)} for k in "xyz"} for n, rows in sets.items()}
    expected = [(k, *[len(bases[n][k]) for n in "abc"], len(bases["a"][k] & bases["b"][k]), len(bases["a"][k] & bases["c"][k])) for k in "xyz"]
    assert sorted(tuple(r) for r in found.collect()) == expected
