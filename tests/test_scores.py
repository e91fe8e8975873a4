"""Scores of models against a count of bases."""

import random

import pytest

from locusframe.operators import intervals, scores


def _disjoint(draw, n, low, high):
    cuts = sorted(draw.sample(range(low, high, 2), 2 * n))
    return list(zip(cuts[::2], cuts[1::2], strict=True))


def _bases(rows):
    return {b for s, e in rows for b in range(s, e + 1)}


def _brute(exons, hits, strand, cs, ce):
    """eaed, aed, coding, other of a transcript; hits: (kind, blocks)."""
    n, model = len(exons), _bases(exons)
    starts, ends = [s for s, _ in exons[1:]], [e for _, e in exons[:-1]]
    agreed, seen, begun, ended = [], [], set(), set()
    coding = sorted((b for b in model if cs <= b <= ce), reverse=strand < 0)
    phase, proteins = {b: i % 3 for i, b in enumerate(coding)}, set()
    for kind, blocks in hits:
        seen += blocks
        for k, (s, e) in enumerate(blocks, 1):
            if kind == "protein":
                whole = range(s, s + 3 * ((e - s + 1) // 3))
                proteins |= {b for b in whole if phase.get(b) == ((b - s) % 3 if strand > 0 else 2 - (b - s) % 3)}
                continue
            at_start = k > 1 and s in starts
            at_end = not at_start and k != n and e in ends
            shared = [(min(e, y) - max(s, x) + 1, y - x + 1) for x, y in exons]
            near = any(10 * m >= 9 * size and ((n == 1 and len(blocks) == 1) or 10 * m >= 9 * (e - s + 1)) for m, size in shared)
            if kind == "est":
                begun |= {s} if at_start else set()
                ended |= {e} if at_end else set()
            if at_start or at_end or near:
                agreed.append((s, e))
    verified = [(s, e) for s, e in exons[1:-1] if s in begun and e in ended]
    evidence, plain, right = _bases(seen) | _bases(verified), _bases(seen), (_bases(agreed) | _bases(verified) | proteins) & model
    eaed = 1 - (len(right) / len(model) + len(right) / len(evidence)) / 2 if evidence else 1.0
    aed = 1 - ((len(plain & model) / len(plain) if plain else 0) + len(plain & model) / len(model)) / 2
    return round(eaed, 9), round(aed, 9), len(coding), any(kind == "other" for kind, _ in hits)


@pytest.mark.parametrize("numbered", [True, False])
def test_model_scores_against_bases(spark, numbered):
    draw = random.Random(11)
    x, b, h, expected = [], [], [], {}
    for t in range(60):
        strand, exons = draw.choice([1, -1]), _disjoint(draw, draw.choice([1, 2, 3, 5]), 1, 160)
        cs, ce = exons[0][0] + draw.choice([0, 7, 40]), exons[-1][1] - draw.choice([0, 5, 40])
        hits = []
        for i in range(draw.choice([0, 1, 4, 7])):
            own = draw.random() < 0.6
            blocks = [(max(1, s + draw.choice([0, 0, 0, 1, -1])), e + draw.choice([0, 0, 0, 2])) for s, e in exons if draw.random() < 0.9] if own else _disjoint(draw, draw.choice([1, 3]), 1, 200)
            blocks = [y for j, y in enumerate(blocks) if y[0] <= y[1] and (j == 0 or y[0] > blocks[j - 1][1])]
            if blocks:
                hits.append((draw.choice(["est", "est", "protein", "other"]), blocks))
        expected[t] = _brute(exons, hits, strand, cs, ce)
        x += [(t, strand, s, e) for s, e in exons]
        b.append((t, strand, cs, ce))
        h += [(t, strand, i, kind, s, e, k, len(blocks)) for i, (kind, blocks) in enumerate(hits) for k, (s, e) in enumerate(blocks, 1)]
    # evidence of no known transcript, or of none, counts for none
    h += [(999, 1, 1, "est", 5, 9, 1, 1), (None, 1, 1, "est", 5, 9, 1, 1)]
    keys, draw_order = ["tx", "strand"], draw.sample(h, len(h))
    blocks = spark.createDataFrame(draw_order, "tx long, strand int, hit long, kind string, s long, e long, k int, m long")
    blocks = blocks if numbered else blocks.drop("k", "m")
    bounds = spark.createDataFrame(b, "tx long, strand int, cs long, ce long")
    found = scores.model_scores(spark.createDataFrame(x, "tx long, strand int, s long, e long"), blocks, keys, bounds)
    assert {r.tx: (round(r.eaed, 9), round(r.aed, 9), r.coding, r.other) for r in found.collect()} == expected


def test_scores_shuffle_a_transcript_once(spark):
    exons = spark.range(9).selectExpr("id % 3 as tx", "1 as strand", "id * 50 as s", "id * 50 + 20 as e")
    blocks = spark.range(30).selectExpr("id % 3 as tx", "1 as strand", "id as hit", "'est' as kind", "id * 9 as s", "id * 9 + 5 as e", "1 as k", "1L as m")
    bounds = exons.groupBy("tx", "strand").agg({"s": "min", "e": "max"}).toDF("tx", "strand", "cs", "ce")
    plan = scores.model_scores(exons, blocks, ["tx", "strand"], bounds)._jdf.queryExecution().sparkPlan().toString()
    executed = scores.model_scores(exons, blocks, ["tx", "strand"], bounds)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    # bounds' own, and that of all rows by transcript
    assert executed.count("Exchange hashpartitioning") == 2


def test_blocks_are_numbered(spark):
    draw = random.Random(3)
    rows = [(k, s, s + draw.choice([0, 3, 20])) for k in "ab" for s in (draw.randrange(1, 400) for _ in range(40))] + [("c", 7, 9), ("c", 7, 9), ("c", 10, 11), ("d", 5, 5)]
    df = spark.createDataFrame(rows, "k string, s long, e long").withColumnRenamed("k", "key")
    expected = []
    for key in "abcd":
        pieces = []
        for s, e in sorted((s, e) for k, s, e in rows if k == key):
            if pieces and s <= pieces[-1][1] + 1:
                pieces[-1][1] = max(pieces[-1][1], e)
            else:
                pieces.append([s, e])
        expected += [(key, s, e, i, len(pieces), pieces[0][0], pieces[-1][1]) for i, (s, e) in enumerate(pieces, 1)]
    assert sorted((r.key, r.s, r.e, r.k, r.m, r.hs, r.he) for r in intervals.blocks(df, ["key"]).collect()) == expected
    assert sorted((r.key, r.s, r.e) for r in intervals.merge(df, ["key"], block=16).collect()) == [x[:3] for x in expected]
    assert sorted((r.key, r.n) for r in intervals.merge(df, ["key"]).where("key >= 'c'").collect()) == [("c", 3), ("d", 1)]
