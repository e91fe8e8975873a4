"""Transforms of alignment hits: a row per block (hit, seqid, strand, s, e and what else a query needs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.operators.intervals import merge
from locusframe.shared import dealt


def length() -> Column:
    """A block's bases."""
    return F.col("e") - F.col("s") + 1


def coordinates(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Each hit's block coordinates, in order, as `s-e` with commas between."""
    row = F.struct("s", "e")
    return blocks.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: F.concat_ws("-", x["s"], x["e"])), ",").alias("coordinates"))


def shattered(blocks: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One hit per block, named after its hit and its place in it (from 1)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return blocks.withColumn("part", place)


def majority_strand(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Z3: the strand of most blocks; 0 counts as plus, a tie goes to plus."""
    return blocks.groupBy(*keys).agg(F.when(F.count_if(F.col("strand") < 0) * 2 > F.count("*"), -1).otherwise(1).alias("strand"), F.count("*").alias("n"))


def natural_ends(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Where a hit begins and ends in its own direction; keys must hold strand."""
    low, high = F.min("s"), F.max("e")
    back = F.col("strand") < 0
    span = blocks.groupBy(*keys).agg(low.alias("_low"), high.alias("_high"))
    return span.select(*keys, F.when(back, F.col("_high")).otherwise(F.col("_low")).alias("begin"), F.when(back, F.col("_low")).otherwise(F.col("_high")).alias("end"))


def identity(blocks: DataFrame, keys: list[str], same: str) -> DataFrame:
    """Identical positions over aligned ones, three decimals."""
    return blocks.groupBy(*keys).agg(F.round(F.sum(same) / F.sum(length()), 3).alias("identity"))


def aligned_share(blocks: DataFrame, keys: list[str], lengths: DataFrame) -> DataFrame:
    """The union of a hit's blocks over the whole length (keys, length), four decimals."""
    size = merge(blocks, keys).groupBy(*keys).agg(F.sum(length()).alias("_bases"))
    return size.join(lengths, keys).select(*keys, F.round(F.col("_bases") / F.col("length"), 4).alias("share"))


def joined_by_name(blocks: DataFrame, keys: list[str], most: int, rows: int | None = None) -> DataFrame:
    """Numbers (from 0) the chains of hits of one name of which each begins at most `most` behind what came before; rows: as for merge."""
    order = Window.partitionBy(*keys).orderBy("s", "e")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    wide = F.when(F.col("s") - before > most, 1).otherwise(0)
    return dealt(blocks, keys, rows).withColumn("_wide", wide).withColumn("chain", F.sum("_wide").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_wide")


def contiguous(blocks: DataFrame, keys: list[str], other: list[str]) -> DataFrame:
    """whether the blocks stand in one order on both sides; `other` orders the hit's own side."""
    mine, theirs = F.row_number().over(Window.partitionBy(*keys).orderBy("s", "e", "id")), F.row_number().over(Window.partitionBy(*keys).orderBy(*other))
    return blocks.withColumn("_a", mine).withColumn("_b", theirs).groupBy(*keys).agg(F.bool_and(F.col("_a") == F.col("_b")).alias("contiguous"))


def parts_or_self(bases: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Each base feature with its parts (key, ps, pe); one without any is its own part."""
    return bases.join(parts, key, "left").withColumns({"ps": F.coalesce("ps", "s"), "pe": F.coalesce("pe", "e")})


def gene_id_or_own(rows: DataFrame, gene: Column, own: Column) -> DataFrame:
    """Groups by gene id; a row without one is a group of its own."""
    return rows.withColumn("cluster", F.coalesce(F.concat(F.lit("g"), gene), F.concat(F.lit("h"), own)))


def coverage_text(pieces: DataFrame, lengths: DataFrame, key: str) -> DataFrame:
    """A sequence's bases as 1 where a piece covers them, else 0; pieces are disjoint."""
    spans = pieces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("_p"))
    zero, one = F.lit("0"), F.lit("1")
    whole = lengths.join(spans, key, "left")
    runs = F.transform("_p", lambda p, i: F.concat(F.repeat(zero, (p["s"] - 1 - F.when(i > 0, F.element_at("_p", F.greatest(i, F.lit(1)))["e"]).otherwise(0)).cast("int")), F.repeat(one, (F.least(p["e"], "length") - p["s"] + 1).cast("int"))))
    text = F.coalesce(F.array_join(runs, ""), F.lit(""))
    return whole.select(key, F.concat(text, F.repeat(zero, (F.col("length") - F.length(text)).cast("int"))).alias("covered"))


def operations(text: Column) -> Column:
    """A text of one-letter operations as runs, letter and length."""
    runs = F.regexp_extract_all(text, F.lit(r"(M+|I+|D+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.left(r, F.lit(1)), F.length(r))), "")


def exons_in_transcript(exons: DataFrame, keys: list[str]) -> DataFrame:
    """Each exon's start (from 0) and end in transcript space, in the strand's direction; end is null for the last."""
    order = Window.partitionBy(*keys).orderBy(F.col("s") * F.col("strand"), F.col("e") * F.col("strand"), "id")
    upto = F.sum(length()).over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = F.lead("id").over(order).isNull()
    return exons.withColumn("start_in", upto - length()).withColumn("junction", F.when(~last, upto)).withColumn("number", F.row_number().over(order))
