"""Genes that compete for the same bases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.operators import graphs
from locusframe.operators.intervals import islands, overlap_join
from locusframe.operators.selection import greedy
from locusframe.shared import stored

BINS = (64, 1024, 1 << 14)


def rivals(a: DataFrame, b: DataFrame, keys: list[str], gene: str, exons: DataFrame | None = None, allow: float = 0.0) -> DataFrame:
    """Pairs (keys, x, y) of genes whose coding spans overlap; with `allow` only those of which one has more than that share of its exons' bases in common with the other.

    exons: gene, s, e (disjoint)."""
    left, right = a.select(*keys, F.col(gene).alias("x"), "s", "e"), b.select(*keys, F.col(gene).alias("y"), "s", "e")
    pairs = overlap_join(left, right, keys, bin_sizes=BINS).where("x <> y").select(*keys, "x", "y")
    if not allow:
        return pairs
    size = exons.groupBy(gene).agg(F.sum(F.col("e") - F.col("s") + 1).alias("_n"))
    mine = pairs.join(exons.select(F.col(gene).alias("x"), "s", "e"), "x")
    theirs = pairs.select("x", "y").join(exons.select(F.col(gene).alias("y"), "s", "e"), "y")
    shared = overlap_join(mine, theirs, ["x", "y"], bin_sizes=BINS).groupBy(*keys, "x", "y").agg(F.sum(F.least("e", "be") - F.greatest("s", "bs") + 1).alias("_shared"))
    sized = shared.join(size.select(F.col(gene).alias("x"), F.col("_n").alias("_nx")), "x").join(size.select(F.col(gene).alias("y"), F.col("_n").alias("_ny")), "y")
    return sized.where(F.col("_shared") > allow * F.least("_nx", "_ny")).select(*keys, "x", "y")


def opposite_strands(genes: DataFrame, keys: list[str], gene: str, supported: Column, rank: list[Column], exons: DataFrame | None = None, allow: float = 0.0) -> DataFrame:
    """Genes that stand when both strands compete for coding bases.

    genes: keys, gene (unique), strand, s and e (coding span). Supported genes stand, whatever they overlap. Of the others those go that
    compete with a supported gene of the other strand; what is left, of both strands, competes once more, and in order
    of `rank` each stands unless it competes with one that stands. Decided per overlap component, so that components are apart.
    allow: see rivals."""
    known = stored(genes.withColumn("_sure", F.coalesce(supported, F.lit(False))))
    sure, doubtful = known.where("_sure"), known.where("not _sure")
    lost = [rivals(doubtful.where(f"strand {here} 0"), sure.where(f"strand {there} 0"), keys, gene, exons, allow).select(F.col("x").alias(gene)) for here, there in ((">", "<"), ("<", ">"))]
    left = stored(doubtful.join(lost[0].union(lost[1]).distinct(), gene, "left_anti"))
    if allow:
        against = rivals(left, left, keys, gene, exons, allow).groupBy(F.col("x").alias(gene)).agg(F.collect_list("y").alias("_against"))
        labelled = islands(left, keys, name="_part").join(against, gene, "left")
        # most compete with none
        alone = labelled.where("_against is null").select(gene)
        order = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*rank))
        chosen = graphs.greedy(labelled.where("_against is not null").withColumn("_rank", order), [*keys, "_part"], "_rank", gene, "_against").select(gene)
        kept = alone.union(chosen)
    else:
        kept = greedy(left, keys, rank, gene).select(gene)
    return sure.select(*genes.columns).union(left.join(kept, gene, "left_semi").select(*genes.columns))
