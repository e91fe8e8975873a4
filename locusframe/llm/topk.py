"""Exact top-k search by Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are whole numbers (floor(scale * x)), scores are integer inner products. Candidates lie in blocks;
each block sorts its rows once by every dimension. A query reads the lists from the end that its component's sign
favours, and scores in full what it meets for the first time. What it has not met is at most the last value read in
every list, and no longer than the block's longest vector; the largest product with these two limits is the bound.
The search leaves the block once the bound is below the query's k-th score. Lists are read as deep as lowers the bound
most per read, which their values alone tell. Where half as many reads as there are rows don't bring the bound
below the k-th score, all rows are scored: lists of random vectors of many dimensions rule nothing out before.

All queries meet one block first; the k-th score found there lets the search stop earlier in all blocks.
Blocks and groups of queries are bounded by their bytes, and per query and block at most k rows go on.

Vectors that are null, or hold null or non-finite components, take no part; vectors meet those of their own length
only, so an empty one scores 0 with empty ones. Ties go to the smaller vec_id, a null vec_id comes last. Rows with
one vec_id are rows of their own: a query leaves out itself, not its repetitions, and is answered once per row. A
query with fewer than k candidates has as many rows as there are. An empty table gives no rows. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.shared import stored
from locusframe.llm.vectors import by_id, dealt, matrix, spread, whole_numbers

FOUND = "query long, query_id long, row long, vec_id long, score long"
#: Multipliers tried for the bound under a limit on length; any of them gives a valid bound.
STRETCH = (1.0, 1.5, 2.5, 5.0)


class SortedLists:
    """A block's rows with a list per dimension, ascending."""

    def __init__(self, rows: np.ndarray, first: int = 4):
        n = len(rows)
        self.rows, self.first = rows, first
        self.order = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)
        values = np.take_along_axis(rows, self.order.T, 0).T
        self.longest = float(np.sqrt((rows * rows).sum(1).max(initial=0)))
        depths = [0]
        while depths[-1] < n:
            depths.append(min(n, max(first, 2 * depths[-1])))
        self.depths = np.array(depths)
        #: The most that is left behind each depth, from the lists' ends and, with the sign turned, from their begins.
        at = np.maximum(self.depths - 1, 0)
        self.down, self.up = values[:, n - 1 - at] if n else values[:, :0], -values[:, at] if n else values[:, :0]
        self.scored = 0

    def plan(self, weight: np.ndarray, left: np.ndarray, length: float, least: float, most: int) -> tuple[bool, np.ndarray]:
        """Whether at most `most` reads bring the bound below `least`, and the level of depth of each list for the fewest such reads, or
        else for the lowest bound that so many reads bring.

        For every multiplier m no row scores more than sum(w x - x^2 / 2m) + longest^2 / 2m with x = min(last, m w), nor than sum(w last)."""
        best: tuple = (False, np.inf, None)
        cost = np.diff(self.depths)
        for stretch in (*STRETCH, None):
            if stretch is None:
                part, rest = weight[:, None] * left, 0.0
            else:
                m = stretch * self.longest / length
                x = np.minimum(left, m * weight[:, None])
                part, rest = weight[:, None] * x - x * x / (2 * m), self.longest**2 / (2 * m)
            bound = float(part[:, 0].sum()) + rest
            gain = part[:, :-1] - part[:, 1:]
            order = np.argsort(-np.minimum.accumulate(gain / cost, 1), axis=None, kind="stable")
            dim, level = np.unravel_index(order, gain.shape)
            reads = np.concatenate([[0], np.cumsum(cost[level])])
            # what an unmet row can score at most after so many steps, with room for rounding
            after = (bound - np.concatenate([[0], np.cumsum(gain.ravel()[order])])) * (1 + np.sign(bound) * 1e-9) + 1e-6
            after = after[:np.searchsorted(reads, most, "right")]
            steps = int(np.argmax(after < least))
            found = bool(after[steps] < least)
            steps = steps if found else len(after) - 1
            worth = reads[steps] if found else after[steps]
            if found > best[0] or (found == best[0] and worth < best[1]):
                best = found, worth, (dim[:steps], level[:steps])
        deep = np.zeros(len(weight), np.int64)
        np.maximum.at(deep, best[2][0], best[2][1] + 1)
        return best[0], deep

    def search(self, query: np.ndarray, k: int, floor: float = -np.inf, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best by score, then row; those below floor may be missing, `own` is left out."""
        n = len(self.rows)
        met = np.zeros(n, bool)
        if own >= 0:
            met[own] = True
        dims = np.flatnonzero(query)
        down = query[dims] > 0
        rows, scores = np.zeros(0, np.int64), np.zeros(0)

        def score(new: np.ndarray) -> None:
            nonlocal rows, scores
            new = np.unique(new[~met[new]])
            met[new] = True
            self.scored += len(new)
            got = self.rows[new] @ query
            high = got >= floor
            rows, scores = np.concatenate([rows, new[high]]), np.concatenate([scores, got[high]])
            best = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[best], scores[best]

        def read(depth: np.ndarray) -> None:
            score(np.concatenate([self.order[d, n - e:] if f else self.order[d, :e] for d, f, e in zip(dims.tolist(), down.tolist(), depth.tolist(), strict=True) if e] or [np.zeros(0, np.int64)]).astype(np.int64))

        if n and len(dims) and self.first * len(dims) < n:
            if floor == -np.inf:
                read(np.full(len(dims), self.first))
            weight, left, length = np.abs(query[dims]), np.where(down[:, None], self.down[dims], self.up[dims]), float(np.sqrt(query @ query))
            for share in (4, 2, 2):
                least = max(floor, scores[-1] if len(scores) == k else -np.inf)
                enough, level = self.plan(weight, left, length, least, n // share)
                read(self.depths[level])
                if enough:
                    return rows, scores
        score(np.arange(n))
        return rows, scores


def _meet(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of each block for each query that comes to it; both have dim, block and part."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        schema = pa.schema([(c, pa.int64()) for c in ("query", "query_id", "row", "vec_id", "score")])
        if rows.num_rows and asked.num_rows:
            dim = key[0].as_py()
            rows = by_id(rows)
            lists, number = SortedLists(matrix(rows, dim)), rows["row"].to_numpy()
            place = dict(zip(number.tolist(), range(len(number)), strict=True))
            floors = asked["floor"].to_pylist()
            for q, i, name, floor in zip(matrix(asked, dim), asked["row"].to_pylist(), asked["vec_id"].to_pylist(), floors, strict=True):
                at, score = lists.search(q, k, -np.inf if floor is None else floor, place.get(i, -1))
                m = len(at)
                out.append(pa.table([pa.array(np.full(m, i)), pa.array([name] * m, pa.int64()), pa.array(number[at]), rows["vec_id"].take(pa.array(at)), pa.array(score.astype(np.int64))], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    key = ["dim", "block", "part"]
    left = candidates.select(*key, "row", "vec_id", "vec").groupBy(*key)
    return left.cogroup(queries.select(*key, "row", "vec_id", "vec", "floor").groupBy(*key)).applyInArrow(run, FOUND)


def search(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024, vector: str = "embedding", most_bytes: int = 16 << 20, least_rows: int = 1024) -> DataFrame:
    """Of each row for which `queries` holds, its k best other rows: query_id, rank (from 1), vec_id, score."""
    rows = whole_numbers(vectors, vector, scale, vec_id=F.col("vec_id").cast("long"), asks=F.coalesce(queries, F.lit(False)))
    candidates, blocks = dealt(rows, most_bytes, least_rows)
    asked = stored(rows.where("asks").select("dim", "row", "vec_id", "vec", F.lit(None).cast("long").alias("floor")))
    size = asked.agg(F.sum(F.col("dim") + 1)).head()[0] or 0
    parts = max(1, -(-8 * size // most_bytes))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    candidates = spread(candidates, "part", parts)
    if blocks > 1:
        first = _meet(candidates.where("block = 0"), spread(asked, "block", 1), k)
        floors = first.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k)
        asked = stored(asked.drop("floor").join(floors.select(F.col("query").alias("row"), F.col("least").alias("floor")), "row", "left"))
    found = _meet(candidates, spread(asked, "block", blocks), k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10"""
