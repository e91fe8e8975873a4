"""Queries that score gene models against evidence: eAED, quality index, order and gates.

Models are the merged blocks of every fifth hit of a contig; hits 1 and 2 behind it stand for ESTs, 3 for a protein, 4 for a prediction."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.operators import intervals, scores
from locusframe.plans.interval_queries import SK, _after
from locusframe.plans.registry import query
from locusframe.shared import stored
from locusframe.sources import adapters as A

TK = ["tx", *SK]
BINS = (64, 1024, 1 << 14)

_MODELS = """mo AS (SELECT *, max(e) OVER (PARTITION BY hit, seqid, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM hsps_q),
    mi AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY hit, seqid, strand ORDER BY s, e, p NULLS FIRST ROWS UNBOUNDED PRECEDING) AS i FROM mo),
    bk AS (SELECT hit, seqid, strand, min(s) AS s, max(e) AS e FROM mi GROUP BY hit, seqid, strand, i),
    ex AS (SELECT hit AS tx, seqid, strand, s, e, row_number() OVER (PARTITION BY hit, seqid, strand ORDER BY s) AS i, count(*) OVER (PARTITION BY hit, seqid, strand) AS n FROM bk WHERE hit % 5 = 0),
    sp AS (SELECT tx, seqid, strand, min(s) AS s, max(e) AS e, min(s) + 30 AS cs, max(e) - 30 AS ce, count(*) AS n FROM ex GROUP BY tx, seqid, strand),
    hs AS (SELECT hit, seqid, strand, min(s) AS s, max(e) AS e, count(*) AS m FROM bk WHERE hit % 5 <> 0 GROUP BY hit, seqid, strand),
    eb AS (SELECT sp.tx, sp.seqid, sp.strand, hs.hit, hs.m, CASE WHEN hs.hit % 5 <= 2 THEN 'est' WHEN hs.hit % 5 = 3 THEN 'protein' ELSE 'other' END AS kind, bk.s, bk.e, sp.n,
      row_number() OVER (PARTITION BY sp.tx, sp.strand, hs.hit ORDER BY bk.s) AS k
      FROM sp JOIN hs ON hs.seqid = sp.seqid AND hs.strand = sp.strand AND hs.s <= sp.e AND sp.s <= hs.e JOIN bk ON bk.hit = hs.hit AND bk.strand = hs.strand AND bk.seqid = hs.seqid),
    """
_EAED = _MODELS + """st AS (SELECT *, k > 1 AND EXISTS (SELECT 1 FROM ex WHERE ex.tx = eb.tx AND ex.strand = eb.strand AND ex.i > 1 AND ex.s = eb.s) AS at_start FROM eb WHERE kind <> 'protein'),
    en AS (SELECT *, NOT at_start AND k <> n AND EXISTS (SELECT 1 FROM ex WHERE ex.tx = st.tx AND ex.strand = st.strand AND ex.i < ex.n AND ex.e = st.e) AS at_end FROM st),
    kp AS (SELECT * FROM en WHERE at_start OR at_end OR EXISTS (SELECT 1 FROM ex WHERE ex.tx = en.tx AND ex.strand = en.strand AND ex.s <= en.e AND en.s <= ex.e
      AND 10 * (least(ex.e, en.e) - greatest(ex.s, en.s) + 1) >= 9 * (ex.e - ex.s + 1) AND ((ex.n = 1 AND en.m = 1) OR 10 * (least(ex.e, en.e) - greatest(ex.s, en.s) + 1) >= 9 * (en.e - en.s + 1)))),
    vf AS (SELECT * FROM ex WHERE i > 1 AND i < n AND EXISTS (SELECT 1 FROM en WHERE en.tx = ex.tx AND en.strand = ex.strand AND kind = 'est' AND at_start AND en.s = ex.s)
      AND EXISTS (SELECT 1 FROM en WHERE en.tx = ex.tx AND en.strand = ex.strand AND kind = 'est' AND at_end AND en.e = ex.e)),
    xb AS (SELECT tx, strand, unnest(range(s, e + 1)) AS b FROM ex),
    cd AS (SELECT tx, strand, b, (row_number() OVER (PARTITION BY tx, strand ORDER BY b * strand) - 1) % 3 AS phase FROM xb JOIN sp USING (tx, strand) WHERE b BETWEEN cs AND ce),
    pb AS (SELECT tx, strand, b, CASE WHEN strand > 0 THEN (b - s) % 3 ELSE 2 - (b - s) % 3 END AS frame FROM (SELECT tx, strand, s, unnest(range(s, s + 3 * ((e - s + 1) // 3))) AS b FROM eb WHERE kind = 'protein')),
    ab AS (SELECT tx, strand, unnest(range(s, e + 1)) AS b FROM kp UNION SELECT tx, strand, unnest(range(s, e + 1)) FROM vf UNION SELECT tx, strand, b FROM cd JOIN pb USING (tx, strand, b) WHERE phase = frame),
    vb AS (SELECT tx, strand, unnest(range(s, e + 1)) AS b FROM eb UNION SELECT tx, strand, unnest(range(s, e + 1)) FROM vf),
    nm AS (SELECT tx, strand, count(*) AS n FROM xb GROUP BY tx, strand), nv AS (SELECT tx, strand, count(*) AS n FROM vb GROUP BY tx, strand),
    na AS (SELECT xb.tx, xb.strand, count(*) AS n FROM xb JOIN ab USING (tx, strand, b) GROUP BY xb.tx, xb.strand),
    ea AS (SELECT sp.tx, sp.seqid, sp.strand, coalesce(1 - (coalesce(na.n, 0) / nm.n + coalesce(na.n, 0) / nv.n) / 2, 1) AS eaed FROM sp JOIN nm USING (tx, strand) LEFT JOIN nv USING (tx, strand) LEFT JOIN na USING (tx, strand))"""


def _models(spark, d):
    """blocks of hits (see intervals.blocks), written once; exons (TK, s, e, hs, he) and spans (TK, s, e, cs, ce)."""
    blocks = stored(intervals.blocks(A.hsps(spark, d, exact=True), ["hit", *SK], rows=A.n_feat(spark, d)))
    exons = blocks.where("hit % 5 = 0").withColumnRenamed("hit", "tx")
    spans = exons.where("k = 1").select(*TK, F.col("hs").alias("s"), F.col("he").alias("e"), (F.col("hs") + 30).alias("cs"), (F.col("he") - 30).alias("ce"))
    return blocks, exons.select(*TK, "s", "e", "hs", "he"), spans


def _evidence(blocks, spans):
    """Evidence blocks of the given spans' models (TK, hit, kind, s, e, k, m): those of hits whose spans overlap."""
    other = blocks.where("hit % 5 <> 0")
    of = F.col("hit") % 5
    hits = other.where("k = 1").select("hit", *SK, F.col("hs").alias("s"), F.col("he").alias("e"))
    met = intervals.overlap_join(spans.select(*TK, "s", "e"), hits, SK, bin_sizes=BINS).select(*TK, "hit")
    evidence = met.join(other.select("hit", *SK, "s", "e", "k", "m"), ["hit", *SK])
    return evidence.withColumn("kind", F.when(of <= 2, "est").when(of == 3, "protein").otherwise("other")).select(*TK, "hit", "kind", "s", "e", "k", "m")


def _parts(spark, d):
    """exons (TK, s, e), spans (TK, s, e, cs, ce) and evidence blocks (TK, hit, kind, s, e); written once, as scores use them many times."""
    blocks, exons, spans = _models(spark, d)
    return exons.select(*TK, "s", "e"), spans, stored(_evidence(blocks, spans).select(*TK, "hit", "kind", "s", "e"))


def _eaed(spark, d):
    blocks, exons, spans = _models(spark, d)
    return scores.model_scores(exons, _evidence(blocks, spans), TK, spans.select(*TK, "cs", "ce"), rows=A.n_feat(spark, d)).select(*TK, "eaed")


@query(*_after("feat feat_q hsps_q", _EAED, "SELECT tx, seqid, strand, round(eaed, 6) AS eaed FROM ea"))
def eaed(spark, d):
    """A4"""
    return _eaed(spark, d).select(*TK, F.round("eaed", 6).alias("eaed"))


_ABAED = """al AS (SELECT a.tx, a.seqid, a.strand, CASE WHEN count(b.tx) > 0 THEN 0.0 ELSE 1.0 END AS abaed FROM sp a
    LEFT JOIN (SELECT hit AS tx, * FROM hs WHERE hit % 5 = 4) b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e GROUP BY a.tx, a.seqid, a.strand)"""


def _abaed(spans, evidence):
    some = evidence.where("kind = 'other'").select(*TK).distinct().withColumn("abaed", F.lit(0.0))
    return spans.select(*TK).join(some, TK, "left").select(*TK, F.coalesce("abaed", F.lit(1.0)).alias("abaed"))


@query(*_after("feat feat_q hsps_q", _MODELS + _ABAED, "SELECT tx, seqid, strand, abaed::DOUBLE AS abaed FROM al"))
def abaed(spark, d):
    """0 where another prediction overlaps the model, else 1 (what the distance to alternatives comes to)."""
    _, spans, evidence = _parts(spark, d)
    return _abaed(spans, evidence)


_AED = """xv AS (SELECT DISTINCT tx, strand, unnest(range(s, e + 1)) AS b FROM eb), n1 AS (SELECT tx, strand, count(*) AS n FROM xv GROUP BY tx, strand), n2 AS (SELECT xb.tx, xb.strand, count(*) AS n FROM xb JOIN xv USING (tx, strand, b) GROUP BY xb.tx, xb.strand),
    ae AS (SELECT sp.tx, sp.strand, 1 - (coalesce(coalesce(n2.n, 0) / n1.n, 0) + coalesce(n2.n, 0) / nm.n) / 2 AS aed FROM sp JOIN nm USING (tx, strand) LEFT JOIN n1 USING (tx, strand) LEFT JOIN n2 USING (tx, strand))"""
_SCORES = _EAED + ", " + _ABAED + ", " + _AED + """, sc AS (SELECT ea.tx, ea.seqid, ea.strand, round(eaed, 6) AS eaed, abaed::DOUBLE AS abaed, round(aed, 6) AS aed, greatest((SELECT count(*) FROM cd WHERE cd.tx = ea.tx AND cd.strand = ea.strand) // 3, 0) AS residues FROM ea JOIN al USING (tx, strand) JOIN ae USING (tx, strand))"""


def _scored(spark, d, residues=None):
    """Scores of all models; with residues, evidence is looked for only for models of more residues, which their exons tell (the others are scored without)."""
    blocks, exons, spans = _models(spark, d)
    bounds = spans.select(*TK, "cs", "ce")
    if residues is not None:
        coding = F.greatest(F.least(F.col("e"), F.col("he") - 30) - F.greatest(F.col("s"), F.col("hs") + 30) + 1, F.lit(0))
        spans = exons.groupBy(*TK).agg(F.max("hs").alias("s"), F.max("he").alias("e"), F.sum(coding).alias("bases")).where(F.col("bases") >= 3 * (residues + 1))
    rows = scores.model_scores(exons, _evidence(blocks, spans), TK, bounds, rows=A.n_feat(spark, d))
    abaed = F.when(F.col("other"), 0.0).otherwise(1.0).alias("abaed")
    return rows.select(*TK, F.round("eaed", 6).alias("eaed"), abaed, F.round("aed", 6).alias("aed"), F.floor(F.col("coding") / 3).cast("long").alias("residues"))


@query(*_after("feat feat_q hsps_q", _SCORES, "SELECT tx, seqid, strand, row_number() OVER (PARTITION BY seqid ORDER BY round(eaed + abaed / 3, 6), aed, abaed, residues DESC, tx, strand) AS place FROM sc"))
def gene_order(spark, d):
    """Models of a contig, best first: eAED plus a third of abAED, AED, abAED, longest protein."""
    w = Window.partitionBy("seqid").orderBy(F.round(F.col("eaed") + F.col("abaed") / 3, 6), "aed", "abaed", F.desc("residues"), "tx", "strand")
    return _scored(spark, d).select(*TK, F.row_number().over(w).alias("place"))


@query(*_after("feat feat_q hsps_q", _SCORES, "SELECT tx, seqid, strand, eaed, aed, residues FROM sc WHERE least(aed, eaed) <= 0.6 AND residues > 10"))
def score_gate(spark, d):
    """models whose better score is under a threshold and whose protein is long enough."""
    return _scored(spark, d, residues=10).where("least(aed, eaed) <= 0.6 and residues > 10").select(*TK, "eaed", "aed", "residues")


def _cut_sql(x: str, n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN '-1' ELSE regexp_replace((floor({x} / {n} * 100 + 1e-9) / 100)::VARCHAR, '\\.0$', '') END"


def _site(kinds: str) -> str:
    return f"EXISTS (SELECT 1 FROM ei WHERE ei.tx = xt.tx AND ei.strand = xt.strand AND {kinds} AND ei.s = xt.s AND ei.e = xt.e)"


_QI = _MODELS + f"""xt AS (SELECT tx, strand, e AS s, nx AS e FROM (SELECT *, lead(s) OVER (PARTITION BY tx, strand ORDER BY s) AS nx FROM ex) WHERE nx IS NOT NULL),
    ei AS (SELECT tx, strand, kind, e AS s, nx AS e FROM (SELECT *, lead(s) OVER (PARTITION BY tx, strand, hit ORDER BY s) AS nx FROM eb) WHERE nx IS NOT NULL),
    sl AS (SELECT tx, strand, count_if({_site("ei.kind = 'est'")}) AS a, count_if({_site("ei.kind = 'other'")}) AS b FROM xt GROUP BY tx, strand),
    fl AS (SELECT ex.*, EXISTS (SELECT 1 FROM eb WHERE eb.tx = ex.tx AND eb.strand = ex.strand AND kind = 'est' AND eb.s = ex.s AND eb.e = ex.e) AS same,
      EXISTS (SELECT 1 FROM eb WHERE eb.tx = ex.tx AND eb.strand = ex.strand AND kind <> 'other' AND eb.s <= ex.e AND ex.s <= eb.e) AS met,
      EXISTS (SELECT 1 FROM eb WHERE eb.tx = ex.tx AND eb.strand = ex.strand AND kind = 'other' AND CASE
        WHEN n = 1 THEN (eb.e = ex.e AND ex.s <= eb.s) OR (eb.s = ex.s AND eb.e <= ex.e) OR (ex.s < eb.s AND eb.e < ex.e) WHEN i = 1 THEN eb.e = ex.e AND ex.s <= eb.s WHEN i = n THEN eb.s = ex.s AND eb.e <= ex.e ELSE eb.s = ex.s AND eb.e = ex.e END) AS told FROM ex),
    xb AS (SELECT tx, strand, unnest(range(s, e + 1)) AS b FROM ex),
    ut AS (SELECT tx, strand, count_if(CASE WHEN strand > 0 THEN b < cs ELSE b > ce END) AS five, count_if(CASE WHEN strand > 0 THEN b > ce ELSE b < cs END) AS three, count_if(b BETWEEN cs AND ce) // 3 AS residues FROM xb JOIN sp USING (tx, strand) WHERE cs <= ce GROUP BY tx, strand),
    cn AS (SELECT tx, seqid, strand, count(*) AS n, count_if(same) AS same, count_if(met) AS met, count_if(told) AS told FROM fl GROUP BY tx, seqid, strand)
    SELECT cn.tx, cn.seqid, cn.strand, concat_ws('|', coalesce(five, 0), {_cut_sql("coalesce(a, 0)", "(n - 1)")}, {_cut_sql("same", "n")}, {_cut_sql("met", "n")}, {_cut_sql("coalesce(b, 0)", "(n - 1)")}, {_cut_sql("told", "n")}, n, coalesce(three, 0), coalesce(residues, 0)) AS qi FROM cn LEFT JOIN sl USING (tx, strand) LEFT JOIN ut USING (tx, strand)"""


@query(*_after("feat feat_q hsps_q", _QI[:_QI.rindex("SELECT cn.tx")].rstrip(), _QI[_QI.rindex("SELECT cn.tx"):]))
def quality_tuple(spark, d):
    """A6, A6d: the quality index's nine fields: 5' UTR, splices and exons that ESTs have, exons that anything meets, splices and exons
    that a prediction has (a first exon needs the same end, a last one the same begin), exons, 3' UTR, residues."""
    exons, spans, evidence = _parts(spark, d)
    w = Window.partitionBy(*TK)
    x = exons.withColumns({"i": F.row_number().over(w.orderBy("s")), "n": F.count("*").over(w)})
    introns = exons.select(*TK, F.col("e").alias("s"), F.lead("s").over(w.orderBy("s")).alias("e")).where("e is not null")
    theirs = evidence.select(*TK, "kind", F.col("e").alias("s"), F.lead("s").over(Window.partitionBy(*TK, "hit").orderBy("s")).alias("e")).where("e is not null")
    flags = theirs.groupBy(*TK, "s", "e").agg(F.bool_or(F.col("kind") == "est").alias("a"), F.bool_or(F.col("kind") == "other").alias("b"))
    splices = introns.join(flags, [*TK, "s", "e"]).groupBy(*TK).agg(F.count_if("a").alias("a"), F.count_if("b").alias("b"))
    pairs = intervals.overlap_join(x, evidence.select(*TK, "kind", "s", "e"), TK, bin_sizes=BINS)
    s, e, p, q = (F.col(c) for c in ("s", "e", "bs", "be"))
    first, last, same = (e == q) & (s <= p), (s == p) & (q <= e), (s == p) & (e == q)
    told = F.when(F.col("n") == 1, first | last | ((s < p) & (q < e))).when(F.col("i") == 1, first).when(F.col("i") == F.col("n"), last).otherwise(same)
    per = pairs.groupBy(*TK, "i").agg(F.bool_or((F.col("kind") == "est") & same).alias("same"), F.bool_or(F.col("kind") != "other").alias("met"), F.bool_or((F.col("kind") == "other") & told).alias("told"))
    counts = per.groupBy(*TK).agg(F.count_if("same").alias("same"), F.count_if("met").alias("met"), F.count_if("told").alias("told"))
    cut = exons.join(spans.select(*TK, "cs", "ce"), TK).where("cs <= ce")
    bases = lambda low, high: F.greatest(high - low + 1, F.lit(0))
    before, behind = bases(F.col("s"), F.least(F.col("e"), F.col("cs") - 1)), bases(F.greatest(F.col("s"), F.col("ce") + 1), F.col("e"))
    plus = F.col("strand") > 0
    ends = cut.groupBy(*TK).agg(F.sum(F.when(plus, before).otherwise(behind)).alias("five"), F.sum(F.when(plus, behind).otherwise(before)).alias("three"), F.expr("sum(greatest(least(e, ce) - greatest(s, cs) + 1, 0)) div 3").alias("residues"))
    n = x.groupBy(*TK).agg(F.count("*").alias("n"))
    all_ = n.join(splices, TK, "left").join(counts, TK, "left").join(ends, TK, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    of = lambda c, m: F.when(m == 0, "-1").otherwise(scores.cut_text(zero(c) / m))
    k = F.col("n")
    return all_.select(*TK, F.concat_ws("|", zero("five"), of("a", k - 1), of("same", k), of("met", k), of("b", k - 1), of("told", k), k, zero("three"), zero("residues")).alias("qi"))


@query(*_after("feat feat_q hsps_q", _MODELS + """cd AS (SELECT ex.tx, ex.seqid, ex.strand, ex.i, eb.hit, CASE WHEN ex.s = eb.s AND ex.e = eb.e THEN '1' WHEN ex.s <= eb.e AND eb.s <= ex.e THEN 'o' ELSE '0' END AS c FROM ex JOIN eb ON eb.tx = ex.tx AND eb.strand = ex.strand),
    hx AS (SELECT tx, seqid, strand, hit, i, bool_or(c = '1') AS same FROM cd GROUP BY ALL), sm AS (SELECT tx, seqid, strand, hit, count_if(same) AS k, count(*) AS n FROM hx GROUP BY ALL)""",
    "SELECT tx, seqid, strand, floor(max(k / n) * 1000 + 1e-9) / 1000 AS share FROM sm GROUP BY tx, seqid, strand"))
def best_share(spark, d):
    """A6e: the largest share of a model's exons that one hit has exactly, cut to three decimals."""
    exons, _, evidence = _parts(spark, d)
    n = exons.groupBy(*TK).agg(F.count("*").alias("n"))
    same = exons.join(evidence.select(*TK, "hit", "s", "e"), [*TK, "s", "e"]).groupBy(*TK, "hit").agg(F.countDistinct("s", "e").alias("k"))
    best = evidence.select(*TK, "hit").distinct().join(same, [*TK, "hit"], "left").groupBy(*TK).agg(F.max(F.coalesce("k", F.lit(0))).alias("k"))
    return best.join(n, TK).select(*TK, (F.floor(F.col("k") / F.col("n") * 1000 + 1e-9) / 1000).cast("double").alias("share"))
