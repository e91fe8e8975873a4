"""Exact search, hard negatives and the prefix trie against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.llm import negatives, prefixes, topk, vectors

VECTORS = "vec_id long, embedding array<float>, label int, row long, dim string, block string, part string, score double, vec string"


def sample(seed=0, n=90, dim=6):
    r = np.random.default_rng(seed)
    m = r.normal(size=(n, dim)).astype(np.float32)
    m[40:60] = m[40] + r.normal(size=(20, dim)).astype(np.float32) * 0.01
    m[60:70] = m[60]
    return [(i, [float(x) for x in v], int(i * 7 % 4)) for i, v in enumerate(m)]


ODD = [
    (100, None, 1), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (102, [float("nan")] * 6, 2), (103, [float("inf")] + [0.0] * 5, 2), (104, [], 3), (110, [], 3), (105, [0.0] * 6, 0), (None, [0.5] * 6, 1),
    (20, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 2), (20, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 2), (106, [0.25, 0.5], 1), (120, [0.5, 0.5], 1), (107, [1.0] * 6, None), (130, [2.0] * 6, None),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", "c", 0.0, "v") for r in rows], VECTORS).repartition(3)


def taking_part(rows, scale):
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            yield i, [math.floor(scale * float(np.float32(x))) for x in v], label


def order(score, i):
    return (-score, i is None, i or 0)


def brute_top_k(rows, k, every):
    rows, out = list(taking_part(rows, 1024)), []
    for a, (i, q, _) in enumerate(rows):
        if i is not None and i % every == 0:
            best = sorted((order(sum(x * y for x, y in zip(q, v, strict=True)), j), j) for b, (j, v, _) in enumerate(rows) if a != b and len(v) == len(q))[:k]
            out += [(i, n + 1, j, -key[0]) for n, (key, j) in enumerate(best)]
    return sorted(out, key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("least_rows", [16, 1000])
def test_top_k(spark, least_rows):
    rows = sample() + ODD
    got = topk.search(frame(spark, rows), F.col("vec_id") % 10 == 0, k=7, least_rows=least_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert plain(got) == brute_top_k(rows, 7, 10)
    # several parts of queries
    assert plain(topk.search(frame(spark, rows), F.col("vec_id") % 10 == 0, k=7, least_rows=least_rows, most_bytes=600)) == brute_top_k(rows, 7, 10)
    assert topk.search(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    few = rows[:1] + rows[40:42]
    assert plain(topk.search(frame(spark, few), F.col("vec_id") % 10 == 0, k=7)) == brute_top_k(few, 7, 10)


def test_threshold_stops_early():
    """Near copies are found without scoring the rest; scores equal a full scan's, ties by place."""
    r = np.random.default_rng(3)
    m = r.normal(size=(4000, 32))
    m[100:130] = m[100] + r.normal(size=(30, 32)) * 0.01
    m = np.floor(1024 * m / np.sqrt((m * m).sum(1, keepdims=True)))
    lists = topk.SortedLists(m)
    for q in (*range(100, 130), 7):
        rows, scores = lists.search(m[q], 10, own=q)
        all_ = m @ m[q]
        all_[q] = -np.inf
        best = np.lexsort((np.arange(4000), -all_))[:10]
        assert rows.tolist() == best.tolist() and scores.tolist() == all_[best].tolist()
    before = lists.scored
    lists.search(m[100], 10, own=100)
    assert lists.scored - before < 2500
    # a floor from elsewhere: what is below it may be missing, what reaches it may not
    all_ = m @ m[7]
    all_[7] = -np.inf
    best = np.lexsort((np.arange(4000), -all_))[:10]
    rows, _ = lists.search(m[7], 10, floor=float(all_[best[4]]), own=7)
    assert rows[:5].tolist() == best[:5].tolist()


def test_too_long_vectors_are_an_error(spark):
    from pyspark.errors import PySparkException

    rows = [(0, [1e6] * 6, 0), (1, [1.0] * 6, 0)]
    with pytest.raises(PySparkException, match="too long"):
        vectors.whole_numbers(frame(spark, rows), "embedding", 1024)


def brute_negatives(rows, every, positives, negatives_):
    rows = [(i, v, (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in rows if label is not None]
    rows, out = list(taking_part(rows, 256)), []
    for a, (i, q, label) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(q, v, strict=True)), j, other) for b, (j, v, other) in enumerate(rows) if a != b and len(v) == len(q)]
        same = sorted(((order(s, j), s, j) for s, j, other in scored if other == label))[:positives]
        for _, ps, p in same:
            fit = sorted((order(s, j), s, j) for s, j, other in scored if other != label and 50 * ps <= 100 * s <= 95 * ps)[:negatives_]
            out += [(i, p, n + 1, j, ps, s) for n, (_, s, j) in enumerate(fit)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least_rows", "most_anchors"), [(16, 5), (1000, 4096)])
def test_hard_negatives(spark, least_rows, most_anchors):
    rows = sample(5) + ODD
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % 4 == 0, label, least_rows=least_rows, most_anchors=most_anchors)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, 4, 5, 3)
    assert len(want) > 30
    assert plain(got) == want
    assert negatives.mine(frame(spark, []), F.col("vec_id") % 4 == 0, label).count() == 0


def test_tree_bounds_rescore_only_what_overlaps():
    r = np.random.default_rng(1)
    centres = r.normal(size=(5, 16)) * 100
    rows = np.floor(centres[r.integers(0, 5, 2000)] + r.normal(size=(2000, 16)))
    anchors = rows[:60]
    parent, edge = negatives.spanning_tree(anchors)
    assert (parent[1:] >= 0).all() and parent[0] == -1
    assert np.allclose(edge[1:], np.sqrt(((anchors[1:] - anchors[parent[1:]]) ** 2).sum(1)))
    scored, seen = 0, set()
    for i, pick, exact in negatives.walk(anchors, parent, edge, rows, lambda i, low, high: high >= np.partition(low, -5)[-5]):
        all_ = rows @ anchors[i]
        best = np.lexsort((np.arange(2000), -all_))[:5]
        assert set(best.tolist()) <= set(pick.tolist()) and (exact == all_[pick]).all()
        scored += len(pick)
        seen.add(i)
    assert len(seen) == 60 and scored < 60 * 2000 * 0.5


TURNS = "conv_id long, turn long, role string, text string, node string, depth string, n string"


def talks(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS).repartition(3)


def some_talks():
    r = np.random.default_rng(2)
    rows = []
    for c in [*range(1, 40), *range(-6, 0), 205, 206]:
        rows += [(c, t, "user" if t % 2 == 0 else "bot", f"say {r.integers(0, 2)}") for t in range(int(r.integers(1, 7)))]
    rows += [(c, t, "user", f"hot {t}") for c in range(300, 330) for t in range(4)]  # copies
    rows += [(50, None, None, None), (50, None, "user", None), (50, 2, "user", "x"), (50, 2, "user", "x"), (51, 0, "user", "ü" * 3000), (None, 0, "user", "lost"), (52, 0, "", ""), (53, 0, None, None)]
    rows += [(60, t, "user", str(t)) for t in range(300)]
    return rows


def brute_trie(rows, rebuild=True):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    by = {c: [x[2:] for x in sorted(t)] for c, t in by.items()}
    made = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        made[c] = by.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    members = {}
    for c, t in made.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        saved[p] = sum(saved[x] for x in children.get(p, [])) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        leaves[p] = sum(leaves[x] for x in children.get(p, [])) or 1
    out = []
    for p, m in members.items():
        ends = hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(p)).encode()).hexdigest()
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p], ends))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("most_convs", "most_turns"), [(2048, 200_000), (7, 200_000), (1, 10), (64, 20)])
def test_trie(spark, most_convs, most_turns):
    rows = some_talks()
    turns = prefixes.numbered_turns(talks(spark, rows))
    opening = F.crc32(F.col("conv_id").cast("string")) % 9
    got = prefixes.trie(prefixes.shared_openings(turns, opening, of=5), most_convs, most_turns)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert plain(got) == brute_trie(rows)


def test_trie_as_it_is_and_empty(spark):
    rows = some_talks()
    assert plain(prefixes.trie(prefixes.as_they_are(prefixes.numbered_turns(talks(spark, rows))))) == brute_trie(rows, rebuild=False)
    for none in ([], [(None, 0, "user", "x")]):
        assert prefixes.trie(prefixes.as_they_are(prefixes.numbered_turns(talks(spark, none)))).count() == 0
