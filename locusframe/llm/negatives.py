"""Hard negatives by bounds along a spanning tree of anchors.

Anchors of one label form minimum spanning trees over their distances. A tree's root scores all candidates of a
block. A child's score of a candidate lies within the parent's, plus or minus the edge's length times the
candidate's norm; where the parent's own score is only known by bounds, these widen by as much. A child scores again
only candidates whose bounds reach what it looks for, which makes their bounds exact for its own children:

* positives: candidates of the anchor's label whose upper bound reaches the k-th largest lower bound;
* negatives: candidates of other labels whose bounds overlap a window that one of the positives sets.

Candidates lie in blocks and anchors in parts, both bounded by their bytes. Per anchor (and positive) at most
k rows leave a block. Bounds of at most HELD nodes are held; a child whose parent's are gone scores like a root.

Rows whose label or vector is null, or whose vector holds null or non-finite components, take no part. Vectors meet
those of their own length only. Ties go to the smaller vec_id, a null vec_id comes last. Rows with one vec_id are rows
of their own: an anchor leaves out itself, not its repetitions. An anchor without positives, or a positive whose window
holds nothing (always if its score is negative), has no rows. An empty table gives no rows. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.shared import stored
from locusframe.llm.vectors import by_id, dealt, matrix, spread, whole_numbers

HELD = 64
KEY = ["dim", "block", "part"]


def spanning_tree(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's parent (-1: the root) and the distance to it, in a minimum spanning tree grown from the first row."""
    n = len(m)
    parent, edge = np.full(n, -1), np.full(n, np.inf)
    squared, inside, at = (m * m).sum(1), np.zeros(n, bool), 0
    for _ in range(n - 1):
        inside[at] = True
        d = np.sqrt(np.maximum(squared + squared[at] - 2 * (m @ m[at]), 0))
        near = ~inside & (d < edge)
        parent[near], edge[near] = at, d[near]
        at = int(np.argmin(np.where(inside, np.inf, edge)))
    edge[0] = 0
    return parent, edge


def walk(anchors: np.ndarray, parent: np.ndarray, edge: np.ndarray, rows: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each anchor with the rows that `wanted` (of its bounds) picks, and their scores; parents come before children."""
    norm, size = np.sqrt((rows * rows).sum(1)), np.sqrt((anchors * anchors).sum(1))
    children: list[list[int]] = [[] for _ in anchors]
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            children[p].append(i)
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    todo = [0] if len(anchors) else []
    while todo:
        i = todo.pop()
        p = int(parent[i])
        if p in held:
            slack = norm * (edge[i] * (1 + 1e-9) + 1e-9 * size[i]) + 1e-6
            low, high = held[p][0] - slack, held[p][1] + slack
            pick = np.flatnonzero(wanted(i, low, high))
            exact = rows[pick] @ anchors[i] if 2 * len(pick) < len(rows) else (rows @ anchors[i])[pick]
            low[pick] = high[pick] = exact
            if i == children[p][0]:  # the last of its siblings
                del held[p]
        else:
            low = high = rows @ anchors[i]
            pick = np.flatnonzero(wanted(i, low, high))
            exact = low[pick]
        yield i, pick, exact
        if children[i]:
            held[i] = low, high
            todo += children[i]
            if len(held) > HELD:
                del held[next(iter(held))]


def _trees(anchors: DataFrame) -> DataFrame:
    """Anchors with parent (a row, null at a root) and edge; a tree spans the anchors of one dim, part and label."""

    def plant(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by("row")
        parent, edge = spanning_tree(matrix(t, key[0].as_py()))
        up = pa.array(parent, mask=parent < 0)
        return t.append_column("parent", t["row"].combine_chunks().take(up)).append_column("edge", pa.array(edge))

    cols = anchors.select("dim", "part", "label", "row", "vec_id", "vec")
    schema = "dim int, part int, label long, row long, vec_id long, vec array<double>, parent long, edge double"
    return stored(cols.groupBy("dim", "part", "label").applyInArrow(plant, schema))


def _by_label(asked: pa.Table, dim: int) -> Iterator[tuple[int, pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """The trees that have come to a block: label, anchors (the root first), vectors, parents as places, edges."""
    asked = asked.sort_by([("label", "ascending"), ("row", "ascending")])
    label = asked["label"].to_numpy()
    ends = np.flatnonzero(np.diff(label, append=label[-1] + 1)) + 1
    for begin, end in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
        t = asked.slice(begin, end - begin)
        at = dict(zip(t["row"].to_pylist(), range(t.num_rows), strict=True))
        parent = np.array([-1 if p is None else at[p] for p in t["parent"].to_pylist()])
        yield int(label[begin]), t, matrix(t, dim), parent, t["edge"].to_numpy()


def _positives(candidates: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """The first k of each anchor's label: anchor, place (from 0), positive_id, score."""
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "row", "vec_id", "score")])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        if rows.num_rows and asked.num_rows:
            dim, rows = key[0].as_py(), by_id(rows)
            m, labels, number = matrix(rows, dim), rows["label"].to_numpy(), rows["row"].to_numpy()
            for label, t, a, parent, edge in _by_label(asked, dim):
                same = np.flatnonzero(labels == label)
                place = dict(zip(number[same].tolist(), range(len(same)), strict=True))
                own = [place.get(r, -1) for r in t["row"].to_pylist()]

                def wanted(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    most = k + (own[i] >= 0)  # noqa: B023  itself may be among the first
                    return high >= np.partition(low, -most)[-most] if len(low) > most else np.ones(len(low), bool)

                names = t["row"].to_numpy()
                for i, pick, score in walk(a, parent, edge, m[same], wanted):
                    score, pick = score[pick != own[i]], pick[pick != own[i]]
                    best = np.lexsort((pick, -score))[:k]
                    at = same[pick[best]]
                    cols = [pa.array(np.full(len(at), names[i])), pa.array(number[at]), rows["vec_id"].take(pa.array(at)), pa.array(score[best].astype(np.int64))]
                    out.append(pa.table(cols, schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    found = candidates.groupBy(*KEY).cogroup(anchors.groupBy(*KEY)).applyInArrow(run, "anchor long, row long, vec_id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    first = found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < k)
    return stored(first.select("anchor", "place", F.col("vec_id").alias("positive_id"), "score"))


def _negatives(candidates: DataFrame, anchors: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """The first k of each positive's window among other labels; anchors carry their positives' scores by place."""
    schema = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), *[(c, pa.int64()) for c in ("row", "vec_id", "score")]])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        if rows.num_rows and asked.num_rows:
            dim, rows = key[0].as_py(), by_id(rows)
            m, labels, number = matrix(rows, dim), rows["label"].to_numpy(), rows["row"].to_numpy()
            for label, t, a, parent, edge in _by_label(asked, dim):
                other = np.flatnonzero(labels != label)
                windows = [[(-(-low * s // 100), high * s // 100) for s in p or ()] for p in t["scores"].to_pylist()]

                def wanted(i: int, least: np.ndarray, most: np.ndarray) -> np.ndarray:
                    inside = np.zeros(len(least), bool)
                    for x, y in set(windows[i]):  # noqa: B023
                        if x <= y:
                            inside |= (most >= x) & (least <= y)
                    return inside

                names = t["row"].to_numpy()
                for i, pick, score in walk(a, parent, edge, m[other], wanted):
                    order = np.lexsort((pick, -score))
                    pick, score = pick[order], score[order]
                    for place, (x, y) in enumerate(windows[i]):
                        begin = int(np.searchsorted(-score, -y, "left"))
                        end = min(begin + k, int(np.searchsorted(-score, -x, "right")))
                        if begin < end:
                            at = other[pick[begin:end]]
                            cols = [np.full(len(at), names[i]), np.full(len(at), place, np.int32), number[at]]
                            out.append(pa.table([*map(pa.array, cols), rows["vec_id"].take(pa.array(at)), pa.array(score[begin:end].astype(np.int64))], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    found = candidates.groupBy(*KEY).cogroup(anchors.groupBy(*KEY)).applyInArrow(run, "anchor long, place int, row long, vec_id long, score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return first.select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))


def mine(vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, vector: str = "embedding", most_bytes: int = 8 << 20, least_rows: int = 1024, most_anchors: int = 4096) -> DataFrame:
    """Per anchor and positive the hardest negatives whose score is `low` to `high` per cent of the positive's.

    anchors says which rows are anchors. Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score."""
    known = vectors.where(label.isNotNull())
    rows = whole_numbers(known, vector, scale, vec_id=F.col("vec_id").cast("long"), label=label.cast("long"), anchors=F.coalesce(anchors, F.lit(False)))
    candidates, blocks = dealt(rows, most_bytes, least_rows)
    own = rows.where("anchors")
    n, size = own.agg(F.count("*"), F.sum(F.col("dim") + 1)).head()
    parts = max(1, -(-n // most_anchors), -(-8 * (size or 0) // most_bytes))
    trees = _trees(own.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")))
    candidates = spread(candidates.select("dim", "block", "row", "vec_id", "label", "vec"), "part", parts)
    found = _positives(candidates, spread(trees, "block", blocks), positives)
    scores = found.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("scores"))
    asked = trees.join(scores.withColumnRenamed("anchor", "row"), "row", "left")
    hard = _negatives(candidates, spread(asked, "block", blocks), negatives, low, high)
    named = found.join(trees.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return hard.join(named, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")


SQL = """
    WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, list_dot_product(a.v, c.v)::BIGINT AS score FROM e a JOIN e c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
    WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 3"""
