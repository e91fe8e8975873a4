"""Graphs as edge tables: walks up an ontology, components, selection along edges. Rounds are written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.shared import stored


def trace(edges: DataFrame) -> DataFrame:
    """O1: every (node, ancestor, depth), nearest depth; edges go from subject to object.

    A round goes one edge farther from what the last round found new, until it finds nothing; cycles end there too."""
    up = stored(edges.select("subject", "object").distinct())
    known = fresh = up.select(F.col("subject").alias("node"), F.col("object").alias("ancestor"), F.lit(1).alias("depth"))
    while True:
        step = fresh.join(up, F.col("ancestor") == F.col("subject")).select("node", F.col("object").alias("ancestor"), (F.col("depth") + 1).alias("depth")).distinct()
        fresh = stored(step.join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti"))
        if fresh.isEmpty():
            return known
        known = stored(known.union(fresh))


def depths(edges: DataFrame) -> DataFrame:
    """The longest way from each node to a root: the last round in which a way of that many edges leads up from it."""
    up = stored(edges.select("subject", "object").distinct())
    most = up.select("subject").distinct().count()
    level, found, n = up.select(F.col("subject").alias("node")).distinct(), None, 1
    while not level.isEmpty():
        if n > most:
            raise ValueError("the ontology has a cycle")
        row = level.withColumn("depth", F.lit(n))
        found = row if found is None else found.union(row)
        level, n = stored(up.join(level.select(F.col("node").alias("object")), "object", "left_semi").select(F.col("subject").alias("node")).distinct()), n + 1
    if found is None:
        return up.select(F.col("subject").alias("node"), F.lit(0).alias("depth"))
    return found.groupBy("node").agg(F.max("depth").alias("depth"))


def leaves_below(edges: DataFrame) -> DataFrame:
    """The longest way from each node down to a leaf."""
    return depths(edges.select(F.col("object").alias("subject"), F.col("subject").alias("object")))


def is_a(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """O2: for pairs (a, b): 1 if b is above a, 2 if they are the same, else 0."""
    up = trace(edges).select(F.col("node").alias("a"), F.col("ancestor").alias("b"), F.lit(1).alias("_up"))
    return pairs.join(up, ["a", "b"], "left").withColumn("relation", F.when(F.col("a") == F.col("b"), 2).otherwise(F.coalesce("_up", F.lit(0)))).drop("_up")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes (node) with the smallest node that edges (x, y) reach; a node without edges is its own.

    Each round every node takes the least label around it and then that label's own label, so that ways shorten as they are walked."""
    both = stored(edges.select("x", "y").union(edges.select("y", "x")).where("x <> y").distinct())
    label = stored(nodes.select("node", F.col("node").alias("component")).distinct())
    while True:
        around = both.join(label, F.col("y") == F.col("node")).groupBy("x").agg(F.min("component").alias("_least")).withColumnRenamed("x", "node")
        least = label.join(around, "node", "left").select("node", "component", F.least("component", F.coalesce("_least", "component")).alias("_to"))
        jump = label.select(F.col("node").alias("_to"), F.col("component").alias("_farther"))
        step = stored(least.join(jump, "_to", "left").select("node", "component", F.least("_to", F.coalesce("_farther", "_to")).alias("to")))
        label = step.select("node", F.col("to").alias("component"))
        if step.where("to <> component").isEmpty():
            return label


def greedy(rows: DataFrame, group: list[str], rank: str, node: str, against: str) -> DataFrame:
    """In order of rank within a group, keeps the rows that no row kept before rules out (`against`: an array of those that could).

    Rows stream through sorted partitions; a group's kept nodes are all that is held."""
    cols = [*group, node]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept = None, set()
        for b in batches:
            keep = []
            for *g, x, others in zip(*(b[c].to_pylist() for c in (*cols, against)), strict=True):
                if g != at:
                    at, kept = g, set()
                free = kept.isdisjoint(others or ())
                if free:
                    kept.add(x)
                keep.append(free)
            yield b.select(cols).filter(pa.array(keep, pa.bool_()))

    ordered = rows.select(*cols, against, rank).repartition(*group).sortWithinPartitions(*group, rank)
    return ordered.mapInArrow(pick, rows.select(*cols).schema)
