"""Coverage scores: how well models agree with evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.operators.frames import phased
from locusframe.operators.intervals import coverage, merge
from locusframe.shared import dealt


def covered(df: DataFrame, keys: list[str], name: str = "bases") -> DataFrame:
    """Bases in the union of a key's intervals."""
    return merge(df, keys).groupBy(*keys).agg(F.sum(F.col("e") - F.col("s") + 1).alias(name))


def agreement(models: DataFrame, evidence: DataFrame, keys: list[str]) -> DataFrame:
    """A1, A2: per key sn (share of evidence that the model has), sp (share of the model with evidence) and aed = 1 - (sn + sp) / 2.

    Keys without evidence have sn = sp = 0."""
    known = evidence.dropna(subset=keys)
    both = coverage({"_model": models, "_evidence": known}, keys, (("_model", "_evidence"),)).where("_model > 0")
    shared = F.col("_model__evidence")
    sn, sp = F.when(F.col("_evidence") > 0, shared / F.col("_evidence")).otherwise(0.0), shared / F.col("_model")
    return both.select(*keys, sn.alias("sn"), sp.alias("sp"), (1 - (sn + sp) / 2).alias("aed"))


def introns(exons: DataFrame, keys: list[str], exclusive: bool = False) -> DataFrame:
    """From an exon's end to the next one's begin; exclusive leaves both bases out and keeps only those of two or more."""
    order = Window.partitionBy(*keys).orderBy("s", "e")
    rows = exons.select(*keys, F.col("e").alias("_e"), F.lead("s").over(order).alias("_n")).where("_n is not null")
    if exclusive:
        return rows.select(*keys, (F.col("_e") + 1).alias("s"), (F.col("_n") - 1).alias("e")).where("e > s")
    return rows.select(*keys, F.col("_e").alias("s"), F.col("_n").alias("e"))


def truncated(x: Column) -> Column:
    """Two decimals, cut and not rounded."""
    return F.floor(x * 100 + 1e-9) / 100


def split_on_gap(hsps: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Numbers the parts (from 0) into which gaps of more than `most` cut a hit."""
    order = Window.partitionBy(*keys).orderBy("s", "e")
    wide = F.when(F.col("s") - F.lag("e").over(order) > most, 1).otherwise(0)
    return hsps.withColumn("_wide", wide).withColumn("part", F.sum("_wide").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_wide")


def stacked_coverage(hsps: DataFrame, keys: list[str]) -> DataFrame:
    """total length over union length."""
    total = hsps.groupBy(*keys).agg(F.sum(F.col("e") - F.col("s") + 1).alias("total"))
    return total.join(covered(hsps, keys), keys).withColumn("coverage", F.col("total") / F.col("bases"))


def phases(cds: DataFrame, keys: list[str], strand: str = "strand") -> DataFrame:
    """K7: the phase of each coding exon, in the strand's direction: (-length so far) mod 3."""
    order = Window.partitionBy(*keys).orderBy(F.col("s") * F.col(strand)).rowsBetween(Window.unboundedPreceding, -1)
    return cds.withColumn("phase", F.pmod(-F.coalesce(F.sum(F.col("e") - F.col("s") + 1).over(order), F.lit(0)), F.lit(3)))


def coding_phase(exons: DataFrame, bounds: DataFrame, keys: list[str], strand: str = "strand") -> DataFrame:
    """Exons cut to their transcript's coding span (keys, cs, ce), with the phase of the first base in the strand's direction:
    the coding bases before it modulo 3. Exons of a transcript are disjoint."""
    cut = exons.join(bounds, keys).where("s <= ce and cs <= e").withColumns({"s": F.greatest("s", "cs"), "e": F.least("e", "ce")})
    order = Window.partitionBy(*keys).orderBy(F.col("s") * F.col(strand)).rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn("phase", F.coalesce(F.sum(F.col("e") - F.col("s") + 1).over(order), F.lit(0)) % 3)


#: What a row is in a transcript's sweep.
_EXON, _EST, _PROTEIN, _OTHER, _ALIGNED, _KNOWN, _INFERRED, _CODONS, _BOUNDS = range(9)
#: What an interval counts for in it: the model, evidence, what is evidence for eAED alone, what agrees in structure, an alternative; codons and coding exons by frame.
_M, _E, _X, _A, _O, _C, _K = 1, 2, 4, 8, 16, (32, 64, 128), (256, 512, 1024)


def eaed(exons: DataFrame, blocks: DataFrame, keys: list[str], bounds: DataFrame | None = None, inferred: DataFrame | None = None) -> DataFrame:
    """A4: per transcript eaed alone (see model_scores)."""
    return model_scores(exons, blocks, keys, bounds, inferred).select(*keys, "eaed")


def model_scores(exons: DataFrame, blocks: DataFrame, keys: list[str], bounds: DataFrame | None = None, inferred: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """A1, A4: per transcript eaed = 1 - (sensitivity + specificity) / 2, where evidence counts only if it agrees in structure; aed, the same
    of all evidence (see agreement); coding, the exons' bases within bounds; other, whether there is a block of that kind.

    exons: keys, s, e, and strand among the keys; disjoint. blocks: keys of the transcript that they are evidence for, hit,
    kind (est, protein or other), s, e, and gap where proteins have gaps or frame shifts (see frames.phased); a block's number in its hit and the
    hit's number of blocks where they are known (k, m). bounds: keys, cs, ce (the
    coding span), without which proteins don't count as agreeing. inferred: keys, s, e of exons that spliced reads bound
    (frames.inferred_exons), which count as evidence. rows: about how many exons and blocks there are, where that is known (see shared.dealt).

    An EST's block agrees if it begins or ends at an inner splice site of the transcript, or if it and an exon cover each other
    by 90 % (of single blocks only the exon needs to be covered). An exon with both splice sites so met by ESTs agrees whole, and counts
    as evidence whole. A protein's bases agree where its codons lie in the transcript's phase (blocks begin with a codon's first base).
    A transcript without evidence has 1. Everything is intervals: no row per base.

    All rows of a transcript are shuffled once, and windows and one sweep over their ends do the rest without a join. What is held of a
    transcript are its exons' ends."""
    nothing = F.lit(None).cast("long")
    kind = F.when(F.col("kind").isNull(), _KNOWN).when(F.col("kind") == "est", _EST).when(F.col("kind") == "protein", _PROTEIN).when(F.col("kind") == "other", _OTHER).otherwise(_ALIGNED)

    def part(df: DataFrame, kind, hit=nothing, k=nothing, m=nothing, p=nothing, s="s", e="e") -> DataFrame:
        return df.select(*keys, F.lit(kind).cast("int").alias("_kind"), F.col(s).cast("long").alias("s"), F.col(e).cast("long").alias("e"), hit.alias("_hit"), k.cast("long").alias("_k"), m.cast("long").alias("_m"), p.cast("long").alias("_p"))

    # evidence of no transcript counts for none
    known = blocks.dropna(subset=keys)
    numbered, gapped = {"k", "m"} <= set(blocks.columns), "gap" in blocks.columns
    hit = F.lit(None).cast(blocks.schema["hit"].dataType)
    all_ = part(exons, _EXON, hit).union(part(known, kind, hit, F.col("k"), F.col("m")) if numbered else part(known, kind, F.col("hit")))
    if inferred is not None:
        all_ = all_.union(part(inferred.dropna(subset=keys), _INFERRED, hit))
    if bounds is not None:
        all_ = all_.union(part(bounds.dropna(subset=keys), _BOUNDS, hit, s="cs", e="ce"))
        if gapped:
            all_ = all_.union(part(phased(known.where("kind = 'protein'")), _CODONS, hit, p=F.col("p")))
    all_ = dealt(all_, keys, rows)
    is_, aligned = lambda *kinds: F.col("_kind").isin(*kinds), F.col("_kind").isin(_EST, _OTHER, _ALIGNED)
    if not numbered:
        of_hit = Window.partitionBy(*keys, "_is_aligned", "_hit")
        all_ = all_.repartition(*keys).withColumn("_is_aligned", aligned).withColumns({"_k": F.row_number().over(of_hit.orderBy("s", "e")), "_m": F.count("*").over(of_hit)})
    # one order for all windows, so that rows are sorted once: the strand's, in which phases are counted
    ordered = all_.drop("_hit", "_is_aligned").withColumn("_at", F.col("s") if bounds is None else F.col("s") * F.col("strand"))
    order = Window.partitionBy(*keys).orderBy("_at")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s, e = F.col("s"), F.col("e")
    of_exon = lambda x: F.when(is_(_EXON), x)
    seen = ordered.select("*", F.collect_list(of_exon(F.struct("s", "e"))).over(whole).alias("_exons"), F.min(of_exon(s)).over(whole).alias("_begin"), F.max(of_exon(e)).over(whole).alias("_end"),
        F.max(F.when(is_(_BOUNDS), s)).over(whole).alias("_cs"), F.max(F.when(is_(_BOUNDS), e)).over(whole).alias("_ce"))
    n = F.size("_exons")
    at_start = (F.col("_k") > 1) & (s != F.col("_begin")) & F.array_contains(F.col("_exons.s"), s)
    # a block's number is held against the transcript's count of exons, as is done with its begin first
    at_end = (F.col("_k") != n) & (e != F.col("_end")) & F.array_contains(F.col("_exons.e"), e)
    seen = seen.withColumn("_site", F.when(~aligned, 0).when(at_start, 1).when(at_end, 2).otherwise(0))

    def covers(x: Column) -> Column:
        shared = F.least(e, x["e"]) - F.greatest(s, x["s"]) + 1
        return (shared * 10 >= (x["e"] - x["s"] + 1) * 9) & (((n == 1) & (F.col("_m") == 1)) | (shared * 10 >= (e - s + 1) * 9))

    agrees = F.when(~aligned, False).when(F.col("_site") > 0, True).otherwise(F.exists("_exons", covers))
    low, high = F.greatest("s", "_cs"), F.least("e", "_ce")
    # the part in which an exon codes, or a protein has whole codons
    inner = {"_low": of_exon(low), "_high": of_exon(high)}
    if bounds is not None and not gapped:
        inner = {"_low": F.when(is_(_PROTEIN), s).otherwise(inner["_low"]), "_high": F.when(is_(_PROTEIN), F.expr("s + 3 * ((e - s + 1) div 3) - 1")).otherwise(inner["_high"])}
    if bounds is not None:
        some = F.col("_cs").isNotNull() & (F.greatest(inner["_low"], F.lit(1)) <= inner["_high"]) if gapped else (is_(_PROTEIN) | F.col("_cs").isNotNull()) & (F.greatest(inner["_low"], F.lit(1)) <= inner["_high"])
        inner = {c: F.when(some, x) for c, x in inner.items()}
    else:
        inner = {c: nothing for c in inner}
    seen = seen.select(*keys, "_kind", "s", "e", "_p", "_at", "_begin", "_end", "_site", agrees.alias("_agrees"), *[x.alias(c) for c, x in inner.items()])
    met = lambda site, x: F.collect_set(F.when(is_(_EST) & (F.col("_site") == site), x)).over(whole)
    coded = F.coalesce(of_exon(F.col("_high") - F.col("_low") + 1), F.lit(0))
    seen = seen.select("*", met(1, s).alias("_starts"), met(2, e).alias("_ends"), F.coalesce(F.sum(coded).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_sofar"))
    verified = (s != F.col("_begin")) & (e != F.col("_end")) & F.array_contains("_starts", s) & F.array_contains("_ends", e)

    def by_frame(x: Column, sets: tuple[int, ...]) -> Column:
        turn = F.pmod(x, F.lit(3))
        return F.when(turn == 0, sets[0]).when(turn == 1, sets[1]).otherwise(sets[2])

    outer = F.when(is_(_EXON), F.when(verified, _M | _X | _A).otherwise(_M)).when(is_(_PROTEIN, _KNOWN), _E).when(is_(_INFERRED), _X).when(is_(_BOUNDS), 0)
    within = F.lit(0)
    if bounds is not None:
        plus = F.col("strand") > 0
        # a codon's first base, and the coding exon's, in the strand's direction: where both are the same modulo 3, bases agree
        of_codon = lambda p: by_frame(F.when(plus, p).otherwise(-p), _C)
        of_coding = by_frame(F.when(plus, F.col("_low") - F.col("_sofar")).otherwise(2 - F.col("_sofar") - F.col("_high")), _K)
        outer = outer.when(is_(_CODONS), of_codon(F.col("_p")))
        within = F.when(F.col("_low").isNull(), 0).when(is_(_EXON), of_coding).otherwise(of_codon(s))
    outer = outer.otherwise(_E + F.when(F.col("_agrees"), _A).otherwise(0) + F.when(is_(_OTHER), _O).otherwise(0))
    spans = seen.select(*keys, F.greatest("s", F.lit(1)).alias("s"), "e", F.greatest("_low", F.lit(1)).alias("_low"), "_high", outer.alias("_outer"), within.alias("_within")).where("s <= e and _outer > 0")
    end = lambda at, by, sets: F.struct(at.alias("at"), F.lit(by).alias("by"), sets.alias("sets"))
    ends = lambda low, high, sets: (end(F.col(low), 1, sets), end(F.col(high) + 1, -1, sets))
    o, i = F.col("_outer"), F.col("_within")
    one, two = F.array(*ends("s", "e", o.bitwiseOR(i))), F.array(*ends("s", "e", o), *ends("_low", "_high", i))
    points = spans.select(*keys, F.explode(F.when((i > 0) & ((F.col("_low") != F.col("s")) | (F.col("_high") != F.col("e"))), two).otherwise(one)).alias("_point")).select(*keys, "_point.at", "_point.by", "_point.sets")
    sweep = Window.partitionBy(*keys).orderBy("at")
    upto = sweep.rowsBetween(Window.unboundedPreceding, 0)
    bits = [_M, _E, _X, _A, *(() if bounds is None else (*_C, *_K))]
    # of ends at one position all but the last have no bases before the next
    swept = points.select(*keys, "sets", (F.lead("at").over(sweep) - F.col("at")).alias("_bases"), *[F.sum(F.when(F.col("sets").bitwiseAND(F.lit(b)) != 0, F.col("by")).otherwise(0)).over(upto).alias(f"_open{b}") for b in bits])
    is_open = lambda b: F.col(f"_open{b}") > 0
    agreed, coding = is_open(_A), F.lit(False)
    if bounds is not None:
        for c, k in zip(_C, _K, strict=True):
            agreed, coding = agreed | (is_open(c) & is_open(k)), coding | is_open(k)
    bases = lambda test: F.sum(F.when(test, F.col("_bases")).otherwise(0))
    found = swept.groupBy(*keys).agg(bases(is_open(_M)).alias("_model"), bases(is_open(_E)).alias("_plain"), bases(is_open(_E) & is_open(_M)).alias("_shared"), bases(is_open(_E) | is_open(_X)).alias("_evidence"),
        bases(is_open(_M) & agreed).alias("_agreed"), bases(coding).alias("coding"), F.bit_or("sets").alias("_sets")).where("_model > 0")
    model, shared, agreed = F.col("_model"), F.col("_shared"), F.col("_agreed")
    score = F.when(F.col("_evidence") > 0, 1 - (agreed / model + agreed / F.col("_evidence")) / 2).otherwise(1.0)
    sn, sp = F.when(F.col("_plain") > 0, shared / F.col("_plain")).otherwise(0.0), shared / model
    return found.select(*keys, score.alias("eaed"), (1 - (sn + sp) / 2).alias("aed"), "coding", (F.col("_sets").bitwiseAND(F.lit(_O)) != 0).alias("other"))


def cut_text(x: Column) -> Column:
    """A share as text, cut to two decimals, without a decimal point where none is needed."""
    return F.regexp_replace(truncated(x).cast("string"), r"\.0$", "")
