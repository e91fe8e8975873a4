"""What the hits of a cluster say together about exons and introns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.operators.intervals import merge, overlap_join
from locusframe.operators.scores import introns
from locusframe.shared import stored

EXON, INTRON = 1, 2


def agreed_runs(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of bases on which all hits of a key (its blocks, with hit) agree: keys, s, e, state (1 exon, 2 intron) and chain.

    A base that only exons cover is exon, one that only introns cover is intron; where both do, or neither, there is
    no run. Runs that touch are one chain. A sweep over the ends of merged exons and introns, with no row per base."""
    parts = [merge(blocks, keys).select(*keys, "s", "e"), merge(introns(blocks, [*keys, "hit"], exclusive=False).select(*keys, (F.col("s") + 1).alias("s"), (F.col("e") - 1).alias("e")).where("s <= e"), keys).select(*keys, "s", "e")]
    ends = None
    for state, part in zip((EXON, INTRON), parts, strict=True):
        opens = part.select(*keys, F.col("s").alias("at"), F.lit(state).alias("by"))
        closes = part.select(*keys, (F.col("e") + 1).alias("at"), F.lit(-state).alias("by"))
        both = opens.union(closes)
        ends = both if ends is None else ends.union(both)
    # exons count 1 and introns 2, so that the sum tells both apart
    points = ends.groupBy(*keys, "at").agg(F.sum("by").alias("by"))
    order = Window.partitionBy(*keys).orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = points.select(*keys, F.col("at").alias("s"), (F.lead("at").over(order) - 1).alias("e"), F.sum("by").over(upto).cast("int").alias("state"))
    runs = swept.where(f"state in ({EXON}, {INTRON}) and e is not null")
    place = Window.partitionBy(*keys).orderBy("s")
    apart = runs.withColumns({"_p": F.lag("e").over(place), "_q": F.lag("state").over(place)})
    touching = F.col("_p") == F.col("s") - 1
    numbered = apart.withColumns({"_run": F.sum(F.when(touching & (F.col("_q") == F.col("state")), 0).otherwise(1)).over(place), "_chain": F.sum(F.when(touching, 0).otherwise(1)).over(place)})
    return numbered.groupBy(*keys, "_chain", "_run", "state").agg(F.min("s").alias("s"), F.max("e").alias("e")).select(*keys, "s", "e", "state", F.col("_chain").alias("chain"))


def extended(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Hits made longer by what the others of their key agree on: keys, hit, s, e.

    Where a hit's first block begins in an agreed exon it grows to that exon's begin, and the agreed exons before it that
    are reached over agreed runs without a break become blocks of it; likewise behind its last block. A hit of one block grows both ways."""
    runs = agreed_runs(blocks, keys)
    w = Window.partitionBy(*keys, "hit")
    placed = blocks.select(*keys, "hit", "s", "e").withColumns({"_first": F.row_number().over(w.orderBy("s", "e")) == 1, "_last": F.row_number().over(w.orderBy(F.desc("s"), F.desc("e"))) == 1})
    # written, as both sides look for their runs and then for those beyond
    exons = stored(runs.where(f"state = {EXON}").select(*keys, "s", "e", "chain"))
    ends = []
    for side, at in (("_first", "s"), ("_last", "e")):
        points = placed.where(side).select(*keys, "hit", F.col(at).alias("s"), F.col(at).alias("e"))
        met = overlap_join(points, exons, keys)
        ends.append(stored(met.select(*keys, "hit", F.col("bs" if at == "s" else "be").alias("_to" + side), F.col("chain").alias("_chain" + side))))
    grown = placed.join(ends[0], [*keys, "hit"], "left").join(ends[1], [*keys, "hit"], "left")
    own = grown.select(*keys, "hit", F.when(F.col("_first"), F.coalesce("_to_first", "s")).otherwise(F.col("s")).alias("s"), F.when(F.col("_last"), F.coalesce("_to_last", "e")).otherwise(F.col("e")).alias("e"))
    more = []
    for end, side in zip(ends, ("_first", "_last"), strict=True):
        beyond = (F.col("e") < F.col("_to_first")) if side == "_first" else (F.col("s") > F.col("_to_last"))
        more.append(end.withColumnRenamed("_chain" + side, "chain").join(exons, [*keys, "chain"]).where(beyond).select(*keys, "hit", "s", "e"))
    return own.union(more[0]).union(more[1])
