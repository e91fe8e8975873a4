"""Ranked, greedy selection."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.operators.intervals import islands, overlap_join
from locusframe.shared import dealt


def _picked(rows: DataFrame, group: list[str], rank: list, cols: list[str]) -> DataFrame:
    """G1 for rows that lie by group in one task: each group is solved in rank order."""

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, begins, ends = None, [], []
        for pdf in batches:
            keep = []
            for *key, s, e in zip(*(pdf[c].tolist() for c in (*group, "s", "e")), strict=True):
                if key != last:
                    last, begins, ends = key, [], []
                k = bisect.bisect_right(begins, e)
                free = not k or ends[k - 1] < s
                if free:  # kept intervals are disjoint, so one neighbour tells
                    begins.insert(k, s)
                    ends.insert(k, e)
                keep.append(free)
            yield pdf.loc[keep, cols]

    ordered = rows.sortWithinPartitions(*group, *rank).select(*dict.fromkeys([*group, *cols]))
    return ordered.mapInPandas(pick, rows.select(*cols).schema)


def greedy(rows: DataFrame, keys: list[str], rank: list, row: str, made: Column | None = None, block: int = 1 << 12, n: int | None = None) -> DataFrame:
    """G1: in rank order, keeps what overlaps nothing kept before.

    The order matters only inside an overlap component, so each component is solved alone. Rows are shuffled once, by blocks of positions, and most
    components lie in one block: they are told and solved where the rows are. A row that reaches into other blocks leaves a mark in each, and only
    components with such a row or mark are put together across blocks. made: what `row` is made of, where rows don't have it; it is made behind
    the shuffle. n: how many rows there are, where that is known. Returns keys, `row`, s and e of the kept rows."""
    cols = [*keys, row, "s", "e"]
    first, last = F.expr(f"floor(s / {block})"), F.expr(f"floor(e / {block})")
    valid = rows.dropna(subset=[*keys, "s", "e"])
    crossing = not valid.where(last > first).isEmpty()
    own = [*keys, "_block"]
    spread = valid.withColumn("_block", F.explode(F.sequence(first, F.greatest(first, last))) if crossing else first)
    # a mark stands at its block's begin
    at = F.greatest("s", F.col("_block") * block) if crossing else F.col("s")
    order = Window.partitionBy(*own).orderBy("_at")
    swept = dealt(spread, own, n).withColumn("_at", at)
    swept = swept.withColumn("_before", F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    swept = swept.withColumn("_part", F.sum(F.when(F.col("_at") <= F.col("_before"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    if made is not None:
        swept = swept.withColumn(row, made)
    if not crossing:
        return _picked(swept, [*own, "_part"], rank, cols)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mark = F.col("_block") > first
    # marks are in a block's first component, and what reaches behind the block in its last
    swept = swept.withColumns({"_marked": F.max(mark).over(whole), "_reach": F.max("e").over(whole), "_parts": F.max("_part").over(whole)})
    is_open = (F.col("_marked") & (F.col("_part") == 1)) | ((F.col("_reach") >= (F.col("_block") + 1) * block) & (F.col("_part") == F.col("_parts")))
    closed = _picked(swept.where(~is_open), [*own, "_part"], rank, cols)
    left = islands(swept.where(is_open & ~mark).drop("_block", "_at", "_before", "_part", "_marked", "_reach", "_parts"), keys, name="_part", block=block)
    return closed.union(_picked(left.repartition(*keys, "_part"), [*keys, "_part"], rank, cols))


def reciprocal_best(pairs: DataFrame, left: str, right: str, distance: str, most: float) -> DataFrame:
    """Pairs that are each other's nearest, no farther than `most`."""
    for_left = Window.partitionBy(left).orderBy(distance, right)
    for_right = Window.partitionBy(right).orderBy(distance, left)
    ranked = pairs.where(F.col(distance) <= most).withColumn("_l", F.row_number().over(for_left)).withColumn("_r", F.row_number().over(for_right))
    return ranked.where("_l = 1 and _r = 1").drop("_l", "_r")


def first_rows(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def unsupported(rows: DataFrame, kept: DataFrame, keys: list[str], flank: int = 0) -> DataFrame:
    """Rows that overlap nothing kept."""
    return overlap_join(rows, kept, keys, flank, "left_anti")
