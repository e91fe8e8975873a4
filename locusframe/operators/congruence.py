"""How well transcripts agree with evidence, by weighted features: exon and intron bases, donors, acceptors, starts and stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.operators.consensus import extended
from locusframe.operators.intervals import merge, overlap_join
from locusframe.operators.scores import agreement, introns
from locusframe.shared import stored

BINS = (64, 1024, 1 << 14)
FEATURES = ("exon", "intron", "donor", "acceptor", "start", "stop")


def _introns(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """What lies between a key's blocks: keys, s, e."""
    return introns(blocks, keys).select(*keys, (F.col("s") + 1).alias("s"), (F.col("e") - 1).alias("e")).where("s <= e")


def _bases(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(F.col("e") - F.col("s") + 1).alias(name))


def _shared(a: DataFrame, b: DataFrame, keys: list[str], by: list[str], name: str) -> DataFrame:
    """Bases that rows of a share with rows of b, summed by `by`."""
    met = overlap_join(a.select(*keys, "s", "e"), b.select(*by, "s", "e"), keys, bin_sizes=BINS)
    return met.groupBy(*by).agg(F.sum(F.least("e", "be") - F.greatest("s", "bs") + 1).alias(name))


def _ends(blocks: DataFrame, keys: list[str]) -> DataFrame:
    return blocks.groupBy(*keys).agg(F.min("s").alias("s"), F.max("e").alias("e"))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def congruence(exons: DataFrame, hits: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """Per transcript (keys) and hit of its evidence the distance: 1 - (common / transcript's + common / hit's) / 2, all features weighted.

    exons: keys, s, e; hits: keys, hit, s, e; blocks of one are disjoint, and hits are on their transcript's strand. A
    donor is an intron's first base, an acceptor its last, in positions; a base that is both counts as acceptor. Where
    introns have no weight their bases aren't compared. Features without a name in weights have none."""
    w = {f: float(weights.get(f, 0)) for f in FEATURES}
    own = [*keys, "hit"]
    ti, hi = _introns(exons, keys), _introns(hits, own)
    transcript = _bases(exons, keys, "te").join(ti.groupBy(*keys).agg(F.count("*").alias("tn"), F.sum(F.col("e") - F.col("s") + 1).alias("ti")), keys, "left")
    transcript = transcript.join(_ends(exons, keys).withColumnsRenamed({"s": "_ts", "e": "_te"}), keys)
    hit = _bases(hits, own, "he").join(hi.groupBy(*own).agg(F.count("*").alias("hn"), F.sum(F.col("e") - F.col("s") + 1).alias("hi")), own, "left")
    hit = hit.join(_ends(hits, own).withColumnsRenamed({"s": "_hs", "e": "_he"}), own)
    both = hit.join(transcript, keys).join(_shared(exons, hits, keys, own, "ce"), own, "left")
    both = both.join(_shared(ti, hi, keys, own, "ci"), own, "left")
    acceptors = hi.select(*own, F.col("e").alias("at"), F.lit("acceptor").alias("kind"))
    donors = hi.where("s < e").select(*own, F.col("s").alias("at"), F.lit("donor").alias("kind"))
    sites = ti.select(*keys, F.explode(F.array(F.struct(F.lit("donor").alias("kind"), F.col("s").alias("at")), F.struct(F.lit("acceptor").alias("kind"), F.col("e").alias("at")))).alias("x")).select(*keys, "x.*")
    same = donors.union(acceptors).join(sites, [*keys, "kind", "at"]).groupBy(*own).agg(F.count_if(F.col("kind") == "donor").alias("cd"), F.count_if(F.col("kind") == "acceptor").alias("ca"))
    both = both.join(same, own, "left")
    at_ends = F.when(F.col("_ts") == F.col("_hs"), w["start"]).otherwise(0.0) + F.when(F.col("_te") == F.col("_he"), w["stop"]).otherwise(0.0)
    common = _zero("ce") * w["exon"] + _zero("ci") * w["intron"] + _zero("cd") * w["donor"] + _zero("ca") * w["acceptor"] + at_ends

    def whole(exon: str, intron: str, n: str) -> Column:
        return F.col(exon) * w["exon"] + _zero(intron) * w["intron"] + _zero(n) * (w["donor"] + w["acceptor"]) + w["start"] + w["stop"]

    return both.select(*own, (1 - (common / whole("te", "ti", "tn") + common / whole("he", "hi", "hn")) / 2).alias("distance"))


def closest(exons: DataFrame, hits: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """Per transcript the distance to all of its evidence at once.

    A base, splice site or end of the transcript is common if any hit has it; the evidence's side are the transcript's bases that hits hold
    for exon or intron (their own weight where they hold it for the other), and the common sites and ends. Without evidence, or where
    it has none of these, the distance is 1."""
    w = {f: float(weights.get(f, 0)) for f in FEATURES}
    ti, hi = _introns(exons, keys), _introns(hits, [*keys, "hit"])
    he, hn = merge(hits, keys).select(*keys, "s", "e"), merge(hi, keys).select(*keys, "s", "e")
    any_ = merge(he.union(hn), keys).select(*keys, "s", "e")

    def covered(of: DataFrame, by: DataFrame, name: str) -> DataFrame:
        met = overlap_join(of.select(*keys, "s", "e"), by, keys, bin_sizes=BINS)
        return met.groupBy(*keys).agg(F.sum(F.least("e", "be") - F.greatest("s", "bs") + 1).alias(name))

    rows = _bases(exons, keys, "te").join(ti.groupBy(*keys).agg(F.count("*").alias("tn"), F.sum(F.col("e") - F.col("s") + 1).alias("ti")), keys, "left")
    for of, by, name in ((exons, he, "ee"), (exons, any_, "ea"), (ti, hn, "ii"), (ti, any_, "ia")):
        rows = rows.join(covered(of, by, name), keys, "left")
    for site, weight in (("s", "donor"), ("e", "acceptor")):
        found = ti.join(hi.select(*keys, site).distinct(), [*keys, site], "left_semi").groupBy(*keys).agg(F.count("*").alias(weight))
        rows = rows.join(found, keys, "left")
    ends, theirs = _ends(exons, keys), _ends(hits, [*keys, "hit"])
    for site, weight in (("s", "start"), ("e", "stop")):
        found = ends.join(theirs.select(*keys, site).distinct(), [*keys, site], "left_semi").select(*keys, F.lit(1).alias(weight))
        rows = rows.join(found, keys, "left")
    at_sites = _zero("donor") * w["donor"] + _zero("acceptor") * w["acceptor"] + _zero("start") * w["start"] + _zero("stop") * w["stop"]
    common = _zero("ee") * w["exon"] + _zero("ii") * w["intron"] + at_sites
    transcript = F.col("te") * w["exon"] + _zero("ti") * w["intron"] + _zero("tn") * (w["donor"] + w["acceptor"]) + w["start"] + w["stop"]
    evidence = common + (_zero("ea") - _zero("ee")) * w["intron"] + (_zero("ia") - _zero("ii")) * w["exon"]
    distance = F.when(evidence > 0, 1 - (common / transcript + common / evidence) / 2).otherwise(1.0)
    return rows.select(*keys, distance.alias("distance"))


def gene_distance(exons: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    """Per gene (keys) AED of the union of its transcripts' exons against the union of its evidence; 1 without evidence."""
    return agreement(exons, hits, keys).select(*keys, F.col("aed").alias("distance"))


def nearest(exons: DataFrame, hits: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """A21, of the two what is nearest: per transcript the distance to the nearest of its longer hits (A22), 1 without evidence."""
    near = congruence(exons, stored(extended(hits, keys)), keys, weights).groupBy(*keys).agg(F.min("distance").alias("_near"))
    rows = exons.select(*keys).distinct().join(near, keys, "left")
    return rows.select(*keys, F.least(F.coalesce("_near", F.lit(1.0)), F.lit(1.0)).alias("nearest"))


def transcript_distance(exons: DataFrame, hits: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """Per transcript the distance to the nearest of its hits after these have been made longer by what all agree on (A22), and to all at once.

    Equal hits give equal distances, so that leaving out redundant ones changes nothing. Without evidence both are 1."""
    rows = closest(exons, hits, keys, weights).withColumnRenamed("distance", "closest")
    return rows.join(nearest(exons, hits, keys, weights), keys, "left").select(*keys, "nearest", "closest")
