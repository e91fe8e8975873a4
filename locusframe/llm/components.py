"""Connected components: blocks of edges are contracted alone, then large-star and small-star steps alternate."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.shared import stored


def _mark(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
    return row[0], row[1]


def _contracted(edges: DataFrame, blocks: int) -> DataFrame:
    """Each block's edges as stars: every node and the smallest node that its block's edges reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for b in batches:
            for x, y in zip(b["a"].to_pylist(), b["b"].to_pylist(), strict=True):
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())], ["a", "b"])

    return edges.repartition(blocks).mapInArrow(run, "a long, b long")


def components(edges: DataFrame, block: int = 250_000) -> DataFrame:
    """edges: a, b (long). Returns node, component (the smallest node reachable) for every node with an edge.

    A block of at most `block` edges is contracted in a task. Each round's edges are written to the shared folder; hot nodes are pre-aggregated, and joins on
    them are left to adaptive skew handling. Self-links and nulls are no edges; no edges give no rows."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    e = stored(e)
    blocks = -(-e.count() // block)
    if blocks:  # at most `block` edges meet in a task, and what one block holds whole needs no rounds
        e = stored(_contracted(e, blocks).distinct())
    before = _mark(e) if blocks > 1 else (0, None)
    while before[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.where("a > b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        e = stored(small.where("a > b").distinct())
        now = _mark(e)
        if now == before:
            break
        before = now
    members = e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(roots)
