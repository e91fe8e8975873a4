"""Queries over genes with local reads: eAED with sequence and gaps, competition of strands, junctions of chunks, consensus of evidence.

Contigs are four parts each and have the document of their number as sequence. Blocks are features moved out to cells of 30, merged. Models are
those of source A by windows of 1,000 positions; reads are the others by windows of 300 and supplier: three in five ESTs, one
a protein, one a prediction. Proteins' gaps follow from their place."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.functions import sequences
from locusframe.operators import codons, competition, consensus, frames, groups, intervals, scores, selection
from locusframe.operators import congruence as congruence_
from locusframe.operators import junctions as junctions_
from locusframe.plans.interval_queries import SK, _after
from locusframe.plans.model_queries import _EAED, _MODELS, BINS, TK
from locusframe.plans.registry import query, table
from locusframe.shared import dealt, stored
from locusframe.sources import adapters as A
from locusframe.sources import alignments, blast

#: The tables of _MODELS (ex, sp, eb) with these models and reads.
_GENES = """fb AS (SELECT CASE WHEN source = 'A' THEN -(seqid // 4 * 10 + (s - 1) // 1000) - 1 ELSE seqid // 4 * 1000 + (s - 1) // 300 * 10 + sup % 5 END AS hit, seqid // 4 AS seqid, strand, s, e FROM feat_q),
    mo AS (SELECT *, max(e) OVER (PARTITION BY hit, seqid, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM fb),
    mi AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY hit, seqid, strand ORDER BY s, e, p NULLS FIRST ROWS UNBOUNDED PRECEDING) AS i FROM mo),
    bk AS (SELECT hit, seqid, strand, min(s) AS s, max(e) AS e FROM mi GROUP BY hit, seqid, strand, i),
    ex AS (SELECT hit AS tx, seqid, strand, s, e, row_number() OVER (PARTITION BY hit, seqid, strand ORDER BY s) AS i, count(*) OVER (PARTITION BY hit, seqid, strand) AS n FROM bk WHERE hit < 0),
    sp AS (SELECT tx, seqid, strand, min(s) AS s, max(e) AS e, min(s) + 30 AS cs, max(e) - 30 AS ce, count(*) AS n FROM ex GROUP BY tx, seqid, strand),
    hs AS (SELECT hit, seqid, strand, min(s) AS s, max(e) AS e, count(*) AS m FROM bk WHERE hit >= 0 GROUP BY hit, seqid, strand),
    eb AS (SELECT sp.tx, sp.seqid, sp.strand, hs.hit, hs.m, CASE WHEN hs.hit % 10 <= 2 THEN 'est' WHEN hs.hit % 10 = 3 THEN 'protein' ELSE 'other' END AS kind, bk.s, bk.e, sp.n,
      row_number() OVER (PARTITION BY sp.tx, sp.strand, hs.hit ORDER BY bk.s) AS k
      FROM sp JOIN hs ON hs.seqid = sp.seqid AND hs.strand = sp.strand AND hs.s <= sp.e AND sp.s <= hs.e JOIN bk ON bk.hit = hs.hit AND bk.strand = hs.strand AND bk.seqid = hs.seqid),
    """
SHORTEST = 60
_INFERRED = f"""rr AS (SELECT tx, seqid, strand, hit, min(s) AS s0, max(e) AS e0, arg_max(s, e) AS b, arg_min(e, s) AS e1 FROM eb WHERE kind = 'est' GROUP BY ALL HAVING count(*) > 1),
    pr AS (SELECT DISTINCT x.tx, x.seqid, x.strand, x.b AS s, y.e1 AS e FROM rr x JOIN rr y ON x.tx = y.tx AND x.strand = y.strand AND y.s0 > x.e0 AND y.e1 - x.b >= {SHORTEST}),
    pc AS (SELECT pr.*, CASE WHEN strand > 0 THEN substr(seq, s, e - s + 1) ELSE reverse(translate(substr(seq, s, e - s + 1), 'ACGT', 'TGCA')) END AS t FROM pr JOIN seqs USING (seqid) WHERE e <= length(seq)),
    ri AS (SELECT tx, seqid, strand, s, e FROM pc WHERE list_bool_or(list_transform([0, 1, 2], lambda f: NOT list_has_any(list_transform(range(f + 1, length(t) - 1, 3), lambda i: substr(t, i, 3)), ['TAA', 'TAG', 'TGA'])))),
    """
_GAP = """CASE (s - 1) // 30 % 4 WHEN 1 THEN concat('M', {n} // 6, 'D2M', {n} // 3 - {n} // 6 - 2) WHEN 2 THEN concat('M', {n} // 6, 'F1M', {n} // 3 - {n} // 6 - 1) WHEN 3 THEN concat('M', {n} // 6, 'R1M', {n} // 3 - {n} // 6) ELSE concat('M', {n} // 3) END"""
_FRAMES = _EAED.replace(_MODELS, _GENES + _INFERRED).replace(
    "pb AS (SELECT tx, strand, b, CASE WHEN strand > 0 THEN (b - s) % 3 ELSE 2 - (b - s) % 3 END AS frame FROM (SELECT tx, strand, s, unnest(range(s, s + 3 * ((e - s + 1) // 3))) AS b FROM eb WHERE kind = 'protein')),",
    f"""g0 AS (SELECT tx, strand, hit, s, e, {_GAP.format(n="(e - s + 1)")} AS gap FROM eb WHERE kind = 'protein'),
    g1 AS (SELECT *, unnest(regexp_extract_all(gap, '([A-Z])\\d+', 1)) AS k, unnest(regexp_extract_all(gap, '[A-Z](\\d+)', 1))::BIGINT AS l, generate_subscripts(regexp_extract_all(gap, '[A-Z]'), 1) AS o FROM g0),
    g2 AS (SELECT *, CASE WHEN k <> 'M' THEN 0 WHEN strand > 0 AND lag(k) OVER w = 'R' THEN lag(l) OVER w WHEN strand < 0 AND lead(k) OVER w = 'R' THEN lead(l) OVER w ELSE 0 END AS r FROM g1 WINDOW w AS (PARTITION BY tx, strand, hit, s ORDER BY o)),
    g3 AS (SELECT *, s - r + coalesce(sum(CASE k WHEN 'F' THEN l WHEN 'D' THEN 3 * l WHEN 'M' THEN 3 * l - r ELSE 0 END) OVER (PARTITION BY tx, strand, hit, s ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS p FROM g2),
    pb AS (SELECT DISTINCT tx, strand, b, CASE WHEN strand > 0 THEN (b - p) % 3 ELSE 2 - (b - p) % 3 END AS frame FROM (SELECT *, unnest(range(p, p + 3 * l)) AS b FROM g3 WHERE k = 'M') WHERE b BETWEEN s AND e),""",
).replace("vb AS (", "vb AS (SELECT tx, strand, unnest(range(s, e + 1)) AS b FROM ri UNION ")


def _gap():
    half, whole = F.expr("(e - s + 1) div 6"), F.expr("(e - s + 1) div 3")
    of = F.expr("(s - 1) div 30 % 4")
    text = lambda op, rest: F.concat(F.lit("M"), half, F.lit(op), whole - half - rest)
    return F.when(of == 1, text("D2M", 2)).when(of == 2, text("F1M", 1)).when(of == 3, text("R1M", 0))


def _parts(spark, d):
    """exons (TK, s, e), spans (TK, s, e, cs, ce) and evidence (TK, hit, kind, s, e, gap), written once."""
    read = F.expr("if(source = 'A', -(seqid div 4 * 10 + (s - 1) div 1000) - 1, seqid div 4 * 1000 + (s - 1) div 300 * 10 + sup % 5)")
    blocks = A.feat_q(spark, d).select(read.alias("hit"), F.expr("seqid div 4").alias("seqid"), "strand", "s", "e")
    blocks = stored(intervals.merge(blocks, ["hit", *SK], rows=A.n_feat(spark, d)).select("hit", *SK, "s", "e"))
    exons = blocks.where("hit < 0").withColumnRenamed("hit", "tx").select(*TK, "s", "e")
    spans = exons.groupBy(*TK).agg(F.min("s").alias("s"), F.max("e").alias("e")).withColumns({"cs": F.col("s") + 30, "ce": F.col("e") - 30})
    reads = blocks.where("hit >= 0")
    whole = reads.groupBy("hit", *SK).agg(F.min("s").alias("s"), F.max("e").alias("e"))
    met = intervals.overlap_join(spans.select(*TK, "s", "e"), whole, SK, bin_sizes=BINS).select(*TK, "hit")
    of = F.col("hit") % 10
    kind = F.when(of <= 2, "est").when(of == 3, "protein").otherwise("other")
    evidence = met.join(reads, ["hit", *SK]).select(*TK, "hit", kind.alias("kind"), "s", "e", F.when(kind == "protein", _gap()).alias("gap"))
    return exons, spans, stored(evidence)


def _inferred(spark, d, evidence, size: int = 2000):
    chunks = stored(frames.chunked(A.seqs(spark, d).select("seqid", "seq"), size))
    return frames.inferred_exons(evidence.where("kind = 'est'").select(*TK, "hit", "s", "e"), TK, chunks, size, SHORTEST)


@query(*_after("feat feat_q seqs", _GENES + _INFERRED + "_x AS (SELECT 1)", "SELECT tx, seqid, strand, s, max(e) AS e FROM ri GROUP BY ALL"))
def inferred_exons(spark, d):
    """A5: exons between spliced reads that read through in one frame; at least 60 bases here, as contigs are short."""
    return _inferred(spark, d, _parts(spark, d)[2])


@query(*_after("feat feat_q seqs", _FRAMES, "SELECT tx, seqid, strand, round(eaed, 6) AS eaed FROM ea"))
def eaed_frames(spark, d):
    """A4, A5: eAED with sequence: exons inferred between spliced reads, and proteins' gaps and frame shifts."""
    exons, spans, evidence = _parts(spark, d)
    found = scores.eaed(exons, evidence, TK, spans.select(*TK, "cs", "ce"), stored(_inferred(spark, d, evidence)))
    return found.select(*TK, F.round("eaed", 6).alias("eaed"))


ALLOW = 0.2
_COMPETITION = _GENES + f"""it AS (SELECT tx, strand, e AS s, nx AS e FROM (SELECT *, lead(s) OVER (PARTITION BY tx, strand ORDER BY s) AS nx FROM ex) WHERE nx IS NOT NULL),
    et AS (SELECT tx, strand, e AS s, nx AS e FROM (SELECT *, lead(s) OVER (PARTITION BY tx, strand, hit ORDER BY s) AS nx FROM eb WHERE kind = 'est') WHERE nx IS NOT NULL),
    cb AS (SELECT tx, strand, sum(greatest(least(ex.e, ce) - greatest(ex.s, cs) + 1, 0))::BIGINT // 3 AS residues FROM ex JOIN (SELECT tx, strand, cs, ce FROM sp) USING (tx, strand) GROUP BY ALL),
    g0 AS (SELECT tx * 2 - CASE WHEN strand > 0 THEN 0 ELSE 1 END AS gene, tx, seqid, strand, cs AS s, ce AS e, residues, EXISTS (SELECT 1 FROM it JOIN et USING (tx, strand, s, e) WHERE it.tx = sp.tx AND it.strand = sp.strand)
      OR EXISTS (SELECT 1 FROM ex JOIN eb USING (tx, strand, s, e) WHERE ex.tx = sp.tx AND ex.strand = sp.strand AND eb.kind <> 'protein') AS sure FROM sp JOIN cb USING (tx, strand) WHERE cs <= ce),
    o1 AS (SELECT *, row_number() OVER (PARTITION BY seqid, strand ORDER BY residues DESC, gene) AS r FROM g0),
    w1 AS (SELECT seqid, strand, 1 AS r, [struct_pack(gene := gene, s := s, e := e)] AS kept FROM o1 WHERE r = 1
      UNION ALL SELECT w1.seqid, w1.strand, o1.r::INT, CASE WHEN len(list_filter(kept, lambda k: k.s <= o1.e AND o1.s <= k.e)) = 0 THEN list_append(kept, struct_pack(gene := o1.gene, s := o1.s, e := o1.e)) ELSE kept END
      FROM w1 JOIN o1 ON o1.seqid = w1.seqid AND o1.strand = w1.strand AND o1.r = w1.r + 1),
    k1 AS (SELECT unnest(kept).gene AS gene FROM (SELECT *, max(r) OVER (PARTITION BY seqid, strand) AS last FROM w1) WHERE r = last),
    g1 AS (SELECT g0.* FROM g0 SEMI JOIN k1 USING (gene)),
    nx AS (SELECT gene, sum(ex.e - ex.s + 1) AS n FROM g1 JOIN ex USING (tx, strand) GROUP BY gene),
    rv AS (SELECT a.gene AS x, b.gene AS y FROM g1 a JOIN g1 b ON a.seqid = b.seqid AND a.gene <> b.gene AND a.s <= b.e AND b.s <= a.e JOIN ex p ON p.tx = a.tx AND p.strand = a.strand JOIN ex q ON q.tx = b.tx AND q.strand = b.strand AND p.s <= q.e AND q.s <= p.e
      JOIN nx m ON m.gene = a.gene JOIN nx n ON n.gene = b.gene GROUP BY a.gene, b.gene, m.n, n.n HAVING sum(least(p.e, q.e) - greatest(p.s, q.s) + 1) > {ALLOW}::DOUBLE * least(m.n, n.n)),
    g2 AS (SELECT * FROM g1 WHERE NOT sure AND NOT EXISTS (SELECT 1 FROM rv JOIN g1 h ON h.gene = rv.y WHERE rv.x = g1.gene AND h.sure AND h.strand <> g1.strand)),
    o2 AS (SELECT *, (SELECT list(y) FROM rv WHERE rv.x = g2.gene) AS against, row_number() OVER (PARTITION BY seqid ORDER BY residues DESC, gene) AS r FROM g2),
    w2 AS (SELECT seqid, 1 AS r, [gene] AS kept FROM o2 WHERE r = 1
      UNION ALL SELECT w2.seqid, o2.r::INT, CASE WHEN list_has_any(kept, coalesce(against, [])) THEN kept ELSE list_append(kept, gene) END FROM w2 JOIN o2 ON o2.seqid = w2.seqid AND o2.r = w2.r + 1),
    k2 AS (SELECT unnest(kept) AS gene FROM (SELECT *, max(r) OVER (PARTITION BY seqid) AS last FROM w2) WHERE r = last)"""


@query(*_after("feat feat_q", _COMPETITION, "SELECT tx, seqid, strand, s, e, residues, sure FROM g1 WHERE sure OR gene IN (SELECT gene FROM k2)"))
def opposite_strands(spark, d):
    """Models with support stand; the others must not compete with one on the other strand, nor with a longer one of either strand that stands."""
    exons, spans, evidence = _parts(spark, d)
    w = Window.partitionBy(*TK)
    site = lambda df, own: df.select(*TK, F.col("e").alias("s"), F.lead("s").over(own.orderBy("s")).alias("e")).where("e is not null")
    splices = site(exons, w).join(site(evidence.where("kind = 'est'").select(*TK, "hit", "s", "e"), Window.partitionBy(*TK, "hit")).distinct(), [*TK, "s", "e"], "left_semi")
    same = exons.join(evidence.where("kind <> 'protein'").select(*TK, "s", "e").distinct(), [*TK, "s", "e"], "left_semi")
    sure = splices.select(*TK).union(same.select(*TK)).distinct().withColumn("sure", F.lit(True))
    cut = exons.join(spans.select(*TK, "cs", "ce"), TK)
    coding = cut.groupBy(*TK).agg(F.expr("sum(greatest(least(e, ce) - greatest(s, cs) + 1, 0)) div 3").alias("residues"))
    gene = F.col("tx") * 2 - F.when(F.col("strand") > 0, 0).otherwise(1)
    genes = spans.where("cs <= ce").join(coding, TK).join(sure, TK, "left")
    genes = stored(genes.select(gene.alias("gene"), *TK, F.col("cs").alias("s"), F.col("ce").alias("e"), "residues", F.coalesce("sure", F.lit(False)).alias("sure")))
    rank = [F.desc("residues"), F.col("gene")]
    apart = genes.join(selection.greedy(genes, SK, rank, "gene").select("gene"), "gene", "left_semi")
    parts = exons.join(genes.select(*TK, "gene"), TK).select("gene", "s", "e")
    found = competition.opposite_strands(apart, ["seqid"], "gene", F.col("sure"), rank, parts, ALLOW)
    return found.select(*TK, "s", "e", "residues", "sure")


SIZE, FLANK = 45, 40
_CHUNKED = f"""ln AS (SELECT seqid, max(e) AS length FROM feat GROUP BY seqid),
    ck AS (SELECT seqid, length, greatest(1, length // {SIZE} + CASE WHEN length % {SIZE} * 2 >= {SIZE} THEN 1 ELSE 0 END) AS n FROM ln),
    ch AS (SELECT seqid, c AS chunk, c * {SIZE} + 1 AS s, CASE WHEN c = n - 1 THEN length ELSE (c + 1) * {SIZE} END AS e, greatest(1, c * {SIZE} + 1 - {FLANK}) AS ws, CASE WHEN c = n - 1 THEN length ELSE least(length, (c + 1) * {SIZE} + {FLANK}) END AS we, c = n - 1 AS is_last
      FROM (SELECT *, unnest(range(0, n)) AS c FROM ck)),
    pd AS (SELECT f.seqid, f.source, f.strand, chunk, f.s, f.e, id FROM feat f JOIN ch ON ch.seqid = f.seqid AND f.s >= ws AND f.e <= we),
    ks AS (SELECT DISTINCT seqid, source, strand FROM pd),
    pl AS (SELECT seqid, source, strand, chunk, list(struct_pack(s := s, e := e, id := id) ORDER BY s, e, id) AS p FROM pd GROUP BY ALL),
    al AS (SELECT ks.*, ch.chunk, ch.e AS ce, is_last, coalesce(p, []) AS p FROM ks JOIN ch USING (seqid) LEFT JOIN pl USING (seqid, source, strand, chunk)),
    go AS (SELECT seqid, source, strand, chunk, 0::BIGINT AS start, list_filter(p, lambda k: k.s <= ce AND k.e > ce)[1] AS x, ce, is_last FROM al WHERE chunk = 0
      UNION ALL SELECT al.seqid, al.source, al.strand, al.chunk, coalesce(go.x.e, go.ce) + 1, list_filter(al.p, lambda k: k.s >= coalesce(go.x.e, go.ce) + 1 AND k.s <= al.ce AND k.e > al.ce)[1], al.ce, al.is_last
      FROM go JOIN al ON al.seqid = go.seqid AND al.source = go.source AND al.strand = go.strand AND al.chunk = go.chunk + 1)"""


@query(*_after("feat", _CHUNKED, """SELECT pd.seqid, pd.source, pd.strand, pd.chunk::INT AS chunk, pd.s, pd.e, pd.id FROM pd JOIN go ON go.seqid = pd.seqid AND go.source = pd.source AND go.strand = pd.strand AND go.chunk = pd.chunk
    WHERE pd.s >= start AND (is_last OR (pd.s <= ce AND CASE WHEN x IS NULL THEN pd.e <= ce ELSE row(pd.s, pd.e, pd.id) <= row(x.s, x.e, x.id) END))"""))
def junctions(spark, d):
    """Features as predictions of chunks of 45 positions with flanks of 40 (so that one may reach over a whole chunk), put together by source and strand."""
    return junctions_.of_features(A.feat(spark, d, parts=True), ["seqid", "source", "strand"], "id", SIZE, FLANK, made=A.feat_id(), n=A.n_feat(spark, d))


#: Bags of evidence: the reads of a contig's strand that lie within 600 positions.
_BAGS = """bg AS (SELECT seqid, strand, (s - 1) // 600 AS bag, CASE WHEN source = 'A' THEN 3 ELSE 0 END + (s - 1) // 300 * 10 + sup % 3 AS hit, s, e FROM (SELECT seqid // 4 AS seqid, strand, s, e, source, sup FROM feat_q) WHERE sup <= 40),
    bo AS (SELECT *, max(e) OVER (PARTITION BY seqid, strand, bag, hit ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM bg),
    bi AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY seqid, strand, bag, hit ORDER BY s, e, p NULLS FIRST ROWS UNBOUNDED PRECEDING) AS i FROM bo),
    bb AS (SELECT seqid, strand, bag, hit, min(s) AS s, max(e) AS e FROM bi GROUP BY seqid, strand, bag, hit, i),
    """
_STATES = _BAGS + """xe AS (SELECT DISTINCT seqid, strand, bag, unnest(range(s, e + 1)) AS b FROM bb),
    ti AS (SELECT *, lead(s) OVER (PARTITION BY seqid, strand, bag, hit ORDER BY s) AS nx FROM bb),
    xi AS (SELECT DISTINCT seqid, strand, bag, unnest(range(e + 1, nx)) AS b FROM ti WHERE nx IS NOT NULL),
    st AS (SELECT seqid, strand, bag, b, CASE WHEN xi.b IS NULL THEN 1 WHEN xe.b IS NULL THEN 2 ELSE -1 END AS state FROM (SELECT *, b AS b_ FROM xe) xe FULL JOIN (SELECT *, b AS b_ FROM xi) xi USING (seqid, strand, bag, b)),
    s1 AS (SELECT * FROM st WHERE state > 0),
    s2 AS (SELECT *, CASE WHEN b = 1 + lag(b) OVER w THEN 0 ELSE 1 END AS nc, CASE WHEN b = 1 + lag(b) OVER w AND state = lag(state) OVER w THEN 0 ELSE 1 END AS nr FROM s1 WINDOW w AS (PARTITION BY seqid, strand, bag ORDER BY b)),
    s3 AS (SELECT *, sum(nc) OVER w AS chain, sum(nr) OVER w AS run FROM s2 WINDOW w AS (PARTITION BY seqid, strand, bag ORDER BY b)),
    ru AS (SELECT seqid, strand, bag, chain, state, min(b) AS s, max(b) AS e FROM s3 GROUP BY seqid, strand, bag, chain, run, state)"""


def _bags(spark, d):
    hit = F.expr("if(source = 'A', 3, 0) + (s - 1) div 300 * 10 + sup % 3")
    rows = A.feat_q(spark, d).where("sup <= 40").select(F.expr("seqid div 4").alias("seqid"), "strand", F.expr("(s - 1) div 600").alias("bag"), hit.alias("hit"), "s", "e")
    return stored(intervals.merge(rows, [*BK, "hit"]).select(*BK, "hit", "s", "e"))


BK = [*SK, "bag"]


@query(*_after("feat feat_q", _STATES, "SELECT seqid, strand, bag, s, e, state FROM ru"))
def agreed_runs(spark, d):
    """A22's states: runs of bases that all reads of a bag hold for exon (1), or for intron (2)."""
    return consensus.agreed_runs(_bags(spark, d), BK).select(*BK, "s", "e", "state")


@query(*_after("feat feat_q", _STATES + """, hl AS (SELECT *, row_number() OVER (PARTITION BY seqid, strand, bag, hit ORDER BY s) = 1 AS f, row_number() OVER (PARTITION BY seqid, strand, bag, hit ORDER BY s DESC) = 1 AS l FROM bb),
    le AS (SELECT h.seqid, h.strand, h.bag, h.hit, r.s AS pt, chain FROM hl h JOIN ru r ON r.seqid = h.seqid AND r.strand = h.strand AND r.bag = h.bag AND state = 1 AND h.s BETWEEN r.s AND r.e WHERE f),
    ri AS (SELECT h.seqid, h.strand, h.bag, h.hit, r.e AS pt, chain FROM hl h JOIN ru r ON r.seqid = h.seqid AND r.strand = h.strand AND r.bag = h.bag AND state = 1 AND h.e BETWEEN r.s AND r.e WHERE l)""",
    """SELECT h.seqid, h.strand, h.bag, h.hit, CASE WHEN f THEN coalesce(le.pt, s) ELSE s END AS s, CASE WHEN l THEN coalesce(ri.pt, e) ELSE e END AS e FROM hl h LEFT JOIN le USING (seqid, strand, bag, hit) LEFT JOIN ri USING (seqid, strand, bag, hit)
    UNION ALL SELECT seqid, strand, bag, hit, ru.s, ru.e FROM le JOIN ru USING (seqid, strand, bag, chain) WHERE state = 1 AND ru.e < pt
    UNION ALL SELECT seqid, strand, bag, hit, ru.s, ru.e FROM ri JOIN ru USING (seqid, strand, bag, chain) WHERE state = 1 AND ru.s > pt"""))
def extended_hits(spark, d):
    """Reads of a bag made longer by the exons that the others agree on."""
    return consensus.extended(_bags(spark, d), BK).select(*BK, "hit", "s", "e")


WEIGHTS = {"exon": 1.0, "intron": 0.5, "donor": 10.0, "acceptor": 10.0, "start": 5.0, "stop": 5.0}
#: Per-base forms; eh: hits' blocks (tx, strand, hit, s, e), which a query sets before.
_HELD = """xb AS (SELECT tx, strand, unnest(range(s, e + 1)) AS b FROM ex),
    xi AS (SELECT tx, strand, e + 1 AS s, nx - 1 AS e FROM (SELECT *, lead(s) OVER (PARTITION BY tx, strand ORDER BY s) AS nx FROM ex) WHERE nx > e + 1),
    xj AS (SELECT tx, strand, unnest(range(s, e + 1)) AS b FROM xi),
    hb AS (SELECT tx, strand, hit, unnest(range(s, e + 1)) AS b FROM eh),
    hi AS (SELECT tx, strand, hit, e + 1 AS s, nx - 1 AS e FROM (SELECT *, lead(s) OVER (PARTITION BY tx, strand, hit ORDER BY s) AS nx FROM eh) WHERE nx > e + 1),
    hj AS (SELECT tx, strand, hit, unnest(range(s, e + 1)) AS b FROM hi),
    tt AS (SELECT tx, strand, min(s) AS s, max(e) AS e, sum(e - s + 1) + 20 * (count(*) - 1) + 10 AS w FROM ex GROUP BY ALL),
    tw AS (SELECT tx, strand, tt.s, tt.e, tt.w + 0.5 * coalesce(x.n, 0) - 20 * (k - coalesce(x.m, 0)) AS w FROM tt JOIN (SELECT tx, strand, count(*) - 1 AS k FROM ex GROUP BY ALL) USING (tx, strand) LEFT JOIN (SELECT tx, strand, sum(e - s + 1) AS n, count(*) AS m FROM xi GROUP BY ALL) x USING (tx, strand)),"""
_CONGRUENCE = """hw AS (SELECT h.tx, h.strand, h.hit, h.s, h.e, h.n + 10 + 0.5 * coalesce(x.n, 0) + 20 * coalesce(x.m, 0) AS w FROM (SELECT tx, strand, hit, min(s) AS s, max(e) AS e, sum(e - s + 1) AS n FROM eh GROUP BY ALL) h
      LEFT JOIN (SELECT tx, strand, hit, sum(e - s + 1) AS n, count(*) AS m FROM hi GROUP BY ALL) x USING (tx, strand, hit)),
    c1 AS (SELECT tx, strand, hit, count(*) AS n FROM hb JOIN xb USING (tx, strand, b) GROUP BY ALL), c2 AS (SELECT tx, strand, hit, count(*) AS n FROM hj JOIN xj USING (tx, strand, b) GROUP BY ALL),
    c3 AS (SELECT h.tx, h.strand, h.hit, count(*) AS n FROM hi h JOIN xi x ON x.tx = h.tx AND x.strand = h.strand AND x.s = h.s WHERE h.s < h.e GROUP BY ALL), c4 AS (SELECT h.tx, h.strand, h.hit, count(*) AS n FROM hi h JOIN xi x ON x.tx = h.tx AND x.strand = h.strand AND x.e = h.e GROUP BY ALL),
    cg AS (SELECT hw.tx, hw.strand, hw.hit, tw.w AS tw, hw.w AS hw, coalesce(c1.n, 0) + 0.5 * coalesce(c2.n, 0) + 10 * coalesce(c3.n, 0) + 10 * coalesce(c4.n, 0) + CASE WHEN hw.s = tw.s THEN 5 ELSE 0 END + CASE WHEN hw.e = tw.e THEN 5 ELSE 0 END AS c
      FROM hw JOIN tw USING (tx, strand) LEFT JOIN c1 USING (tx, strand, hit) LEFT JOIN c2 USING (tx, strand, hit) LEFT JOIN c3 USING (tx, strand, hit) LEFT JOIN c4 USING (tx, strand, hit)),
    ds AS (SELECT tx, strand, hit, 1 - (c / tw + c / hw) / 2 AS distance FROM cg)"""
_CLOSEST = """k1 AS (SELECT tx, strand, sum(CASE WHEN h.b IS NOT NULL THEN 1 ELSE 0 END) AS c, sum(CASE WHEN h.b IS NULL AND i.b IS NOT NULL THEN 0.5 ELSE 0 END) AS o FROM xb LEFT JOIN (SELECT DISTINCT tx, strand, b FROM hb) h USING (tx, strand, b) LEFT JOIN (SELECT DISTINCT tx, strand, b FROM hj) i USING (tx, strand, b) GROUP BY tx, strand),
    k2 AS (SELECT tx, strand, sum(CASE WHEN i.b IS NOT NULL THEN 0.5 ELSE 0 END) AS c, sum(CASE WHEN i.b IS NULL AND h.b IS NOT NULL THEN 1 ELSE 0 END) AS o FROM xj LEFT JOIN (SELECT DISTINCT tx, strand, b FROM hb) h USING (tx, strand, b) LEFT JOIN (SELECT DISTINCT tx, strand, b FROM hj) i USING (tx, strand, b) GROUP BY tx, strand),
    k3 AS (SELECT tx, strand, 10 * count_if(EXISTS (SELECT 1 FROM hi WHERE hi.tx = xi.tx AND hi.strand = xi.strand AND hi.s = xi.s)) + 10 * count_if(EXISTS (SELECT 1 FROM hi WHERE hi.tx = xi.tx AND hi.strand = xi.strand AND hi.e = xi.e)) AS c FROM xi GROUP BY tx, strand),
    he AS (SELECT tx, strand, hit, min(s) AS s, max(e) AS e FROM eh GROUP BY ALL),
    k4 AS (SELECT tx, strand, w, CASE WHEN EXISTS (SELECT 1 FROM he WHERE he.tx = tw.tx AND he.strand = tw.strand AND he.s = tw.s) THEN 5 ELSE 0 END + CASE WHEN EXISTS (SELECT 1 FROM he WHERE he.tx = tw.tx AND he.strand = tw.strand AND he.e = tw.e) THEN 5 ELSE 0 END AS c FROM tw),
    kk AS (SELECT tx, strand, w, k1.c + coalesce(k2.c, 0) + coalesce(k3.c, 0) + k4.c AS c, k1.o + coalesce(k2.o, 0) AS o FROM k4 JOIN k1 USING (tx, strand) LEFT JOIN k2 USING (tx, strand) LEFT JOIN k3 USING (tx, strand)),
    cl AS (SELECT tx, strand, CASE WHEN c + o > 0 THEN 1 - (c / w + c / (c + o)) / 2 ELSE 1 END AS closest FROM kk)"""
_EH = "eh AS (SELECT tx, strand, hit, s, e FROM eb WHERE kind <> 'other'), "


def _aligned(evidence):
    return evidence.where("kind <> 'other'").select(*TK, "hit", "s", "e")


@query(*_after("feat feat_q", _GENES + _EH + _HELD + _CONGRUENCE, "SELECT ds.tx, sp.seqid, ds.strand, hit, round(distance, 6) AS distance FROM ds JOIN sp USING (tx, strand)"))
def weighted_congruence(spark, d):
    """Each model against each of its ESTs and proteins, by weighted exons, introns, splice sites and ends."""
    exons, _, evidence = _parts(spark, d)
    return congruence_.congruence(exons, _aligned(evidence), TK, WEIGHTS).withColumn("distance", F.round("distance", 6)).select(*TK, "hit", "distance")


@query(*_after("feat feat_q", _GENES + _EH + _HELD + _CLOSEST, "SELECT cl.tx, sp.seqid, cl.strand, round(closest, 6) AS distance FROM cl JOIN sp USING (tx, strand)"))
def closest_evidence(spark, d):
    """Each model against all of its ESTs and proteins at once."""
    exons, _, evidence = _parts(spark, d)
    return congruence_.closest(exons, _aligned(evidence), TK, WEIGHTS).withColumn("distance", F.round("distance", 6))


@query(*_after("feat feat_q", _GENES + _EH + """gn AS (SELECT tx, seqid, strand, s, e, sum(nw) OVER (PARTITION BY seqid, strand ORDER BY s, e, tx ROWS UNBOUNDED PRECEDING) AS gene FROM (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY seqid, strand ORDER BY s, e, tx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 1 ELSE 0 END AS nw FROM sp)),
    gx AS (SELECT DISTINCT gn.seqid, gn.strand, gene, unnest(range(ex.s, ex.e + 1)) AS b FROM ex JOIN gn USING (tx, strand)), gv AS (SELECT DISTINCT gn.seqid, gn.strand, gene, unnest(range(eh.s, eh.e + 1)) AS b FROM eh JOIN gn USING (tx, strand)),
    n1 AS (SELECT seqid, strand, gene, count(*) AS n FROM gx GROUP BY ALL), n2 AS (SELECT seqid, strand, gene, count(*) AS n FROM gv GROUP BY ALL), n3 AS (SELECT seqid, strand, gene, count(*) AS n FROM gx JOIN gv USING (seqid, strand, gene, b) GROUP BY ALL)""",
    "SELECT seqid, strand, gene::BIGINT + 1 AS gene, round(1 - (coalesce(n3.n / n2.n, 0) + coalesce(n3.n, 0) / n1.n) / 2, 6) AS distance FROM n1 LEFT JOIN n2 USING (seqid, strand, gene) LEFT JOIN n3 USING (seqid, strand, gene)"))
def gene_aed(spark, d):
    """Models of a strand that overlap or touch are one gene, held against all of their ESTs and proteins."""
    exons, spans, evidence = _parts(spark, d)
    genes = stored(intervals.islands(spans.select(*TK, "s", "e"), SK, name="gene").select(*TK, "gene"))
    key = [*SK, "gene"]
    found = congruence_.gene_distance(exons.join(genes, TK).select(*key, "s", "e"), _aligned(evidence).join(genes, TK).select(*key, "s", "e"), key)
    return found.withColumn("distance", F.round("distance", 6))


_EXTENDED = """b0 AS (SELECT tx, strand, hit, s, e, row_number() OVER (PARTITION BY tx, strand, hit ORDER BY s) = 1 AS f, row_number() OVER (PARTITION BY tx, strand, hit ORDER BY s DESC) = 1 AS l FROM eb WHERE kind <> 'other'),
    b1 AS (SELECT DISTINCT tx, strand, unnest(range(s, e + 1)) AS b FROM b0), b2 AS (SELECT DISTINCT tx, strand, unnest(range(e + 1, nx)) AS b FROM (SELECT *, lead(s) OVER (PARTITION BY tx, strand, hit ORDER BY s) AS nx FROM b0) WHERE nx IS NOT NULL),
    t1 AS (SELECT tx, strand, b, CASE WHEN y.v IS NULL THEN 1 WHEN x.v IS NULL THEN 2 ELSE -1 END AS state FROM (SELECT *, 1 AS v FROM b1) x FULL JOIN (SELECT *, 1 AS v FROM b2) y USING (tx, strand, b)),
    t2 AS (SELECT *, CASE WHEN b = 1 + lag(b) OVER w THEN 0 ELSE 1 END AS nc, CASE WHEN b = 1 + lag(b) OVER w AND state = lag(state) OVER w THEN 0 ELSE 1 END AS nr FROM t1 WHERE state > 0 WINDOW w AS (PARTITION BY tx, strand ORDER BY b)),
    t3 AS (SELECT *, sum(nc) OVER w AS chain, sum(nr) OVER w AS run FROM t2 WINDOW w AS (PARTITION BY tx, strand ORDER BY b)),
    ru AS (SELECT tx, strand, chain, min(b) AS s, max(b) AS e FROM t3 WHERE state = 1 GROUP BY tx, strand, chain, run),
    le AS (SELECT h.tx, h.strand, h.hit, r.s AS pt, chain FROM b0 h JOIN ru r ON r.tx = h.tx AND r.strand = h.strand AND h.s BETWEEN r.s AND r.e WHERE f),
    re AS (SELECT h.tx, h.strand, h.hit, r.e AS pt, chain FROM b0 h JOIN ru r ON r.tx = h.tx AND r.strand = h.strand AND h.e BETWEEN r.s AND r.e WHERE l),
    eh AS (SELECT h.tx, h.strand, h.hit, CASE WHEN f THEN coalesce(le.pt, s) ELSE s END AS s, CASE WHEN l THEN coalesce(re.pt, e) ELSE e END AS e FROM b0 h LEFT JOIN le USING (tx, strand, hit) LEFT JOIN re USING (tx, strand, hit)
      UNION ALL SELECT tx, strand, hit, ru.s, ru.e FROM le JOIN ru USING (tx, strand, chain) WHERE ru.e < pt UNION ALL SELECT tx, strand, hit, ru.s, ru.e FROM re JOIN ru USING (tx, strand, chain) WHERE ru.s > pt),
    """


@query(*_after("feat feat_q", _GENES + _EXTENDED + _HELD + _CONGRUENCE, "SELECT sp.tx, sp.seqid, sp.strand, round(least(coalesce(min(distance), 1), 1), 6) AS nearest FROM sp LEFT JOIN ds USING (tx, strand) GROUP BY ALL"))
def transcript_aed(spark, d):
    """Each model against the nearest of its ESTs and proteins after these have been made longer by what all agree on."""
    exons, _, evidence = _parts(spark, d)
    return congruence_.nearest(exons, stored(_aligned(evidence)), TK, WEIGHTS).withColumn("nearest", F.round("nearest", 6))


_DOMAINS = """dm AS (SELECT seqid // 4 AS seqid, strand, sup % 10 AS domain, row_number() OVER (PARTITION BY seqid // 4, strand, sup % 10 ORDER BY okey, id) AS i, s, e FROM feat),
    w1 AS (SELECT seqid, strand, domain, 1::BIGINT AS i, [[struct_pack(i := i, s := s, e := e)]] AS g FROM dm WHERE i = 1
      UNION ALL SELECT w1.seqid, w1.strand, w1.domain, dm.i, CASE WHEN hit IS NULL THEN list_append(w1.g, [struct_pack(i := dm.i, s := dm.s, e := dm.e)])
        ELSE list_transform(w1.g, lambda x, k: CASE WHEN k = hit THEN list_append(x, struct_pack(i := dm.i, s := dm.s, e := dm.e)) ELSE x END) END
      FROM (SELECT w1.*, dm.i AS ni, dm.s AS ns, dm.e AS ne, list_filter(list_transform(w1.g, lambda x, k: CASE WHEN len(list_filter(x, lambda m: 2 * (least(m.e, dm.e) - greatest(m.s, dm.s) + 1) > least(m.e - m.s + 1, dm.e - dm.s + 1))) > 0 THEN k END), lambda k: k IS NOT NULL)[1] AS hit
        FROM w1 JOIN dm ON dm.seqid = w1.seqid AND dm.strand = w1.strand AND dm.domain = w1.domain AND dm.i = w1.i + 1) w1 JOIN dm ON dm.seqid = w1.seqid AND dm.strand = w1.strand AND dm.domain = w1.domain AND dm.i = w1.ni),
    g1 AS (SELECT seqid, strand, domain, unnest(g) AS x FROM (SELECT *, max(i) OVER (PARTITION BY seqid, strand, domain) AS last FROM w1) WHERE i = last),
    g2 AS (SELECT seqid, strand, domain, list_min(list_transform(x, lambda m: m.i)) AS o, list_min(list_transform(x, lambda m: m.s)) * 3 - 2 AS s, list_max(list_transform(x, lambda m: m.e)) * 3 AS e FROM g1),
    g3 AS (SELECT *, row_number() OVER (PARTITION BY seqid, strand, domain ORDER BY o) AS i FROM g2),
    w2 AS (SELECT seqid, strand, domain, 1::BIGINT AS i, [struct_pack(o := o, s := s, e := e, b := s, t := e, n := 1::BIGINT)] AS g FROM g3 WHERE i = 1
      UNION ALL SELECT v.seqid, v.strand, v.domain, v.ni, CASE WHEN hit IS NULL THEN list_append(v.g, struct_pack(o := v.no, s := v.ns, e := v.ne, b := v.ns, t := v.ne, n := 1::BIGINT))
        ELSE list_transform(v.g, lambda x, k: CASE WHEN k = hit THEN struct_pack(o := x.o, s := x.s, e := x.e, b := least(x.b, v.ns), t := greatest(x.t, v.ne), n := x.n + 1) ELSE x END) END
      FROM (SELECT w2.*, g3.i AS ni, g3.o AS no, g3.s AS ns, g3.e AS ne, list_filter(list_transform(w2.g, lambda x, k: CASE WHEN 2 * (least(x.e, g3.e) - greatest(x.s, g3.s) + 1) > least(x.e - x.s + 1, g3.e - g3.s + 1) THEN k END), lambda k: k IS NOT NULL)[1] AS hit
        FROM w2 JOIN g3 ON g3.seqid = w2.seqid AND g3.strand = w2.strand AND g3.domain = w2.domain AND g3.i = w2.i + 1) v),
    g4 AS (SELECT seqid, strand, domain, unnest(g) AS x FROM (SELECT *, max(i) OVER (PARTITION BY seqid, strand, domain) AS last FROM w2) WHERE i = last)"""


@query(*_after("feat", _DOMAINS, "SELECT seqid, strand, domain, x.o AS i, x.b AS s, x.t AS e, x.n AS n FROM g4"))
def domain_groups(spark, d):
    """C14: features as hits of ten domains (by supplier) on a contig's strand, in order of their orders, grouped as they come."""
    rows = A.feat(spark, d).select(F.expr("seqid div 4").alias("seqid"), "strand", F.expr("sup % 10").alias("domain"), "okey", "id", "s", "e")
    keys = [*SK, "domain"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("okey", "id")).cast("long")
    n = A.n_feat(spark, d)
    return groups.domain_groups(stored(dealt(rows, keys, n).withColumn("i", place).select(*keys, "i", "s", "e")), keys, "i", n)


@query("", """WITH v AS (SELECT doc_id, list_transform(range(0, 2 + doc_id % 5), lambda k: struct_pack(m := 3 + (doc_id + k) % 7, g := (doc_id + 2 * k) % 3, i := 40 + (doc_id * 7 + k) % 50)) AS x, doc_id % 2 = 0 AS plus FROM documents),
    p AS (SELECT doc_id, plus, unnest(x) AS o, generate_subscripts(x, 1) AS k, len(x) AS n FROM v),
    r AS (SELECT *, 3 * o.m + o.g AS bases, coalesce(sum(3 * o.m + o.g + 4 + o.i) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
      coalesce(sum(o.m) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS q FROM p)
    SELECT doc_id, k::INT AS exon, (CASE WHEN plus THEN 1001 + before ELSE 100000 - before - bases + 1 END)::BIGINT AS s, (CASE WHEN plus THEN 1000 + before + bases ELSE 100000 - before END)::BIGINT AS e, (q + 1)::BIGINT AS q_b, (q + o.m)::BIGINT AS q_e,
      concat('M', o.m, CASE o.g WHEN 0 THEN '' ELSE concat('F', o.g) END) AS gap FROM r""")
def vulgar_exons(spark, d):
    """S21c, S21d: documents' ids as alignments of proteins, written as operation lines and read back as exons."""
    n = F.expr("2 + doc_id % 5")
    places = F.sequence(F.lit(0).cast("long"), n - 1)
    m, g, i = (lambda k: 3 + (F.col("doc_id") + k) % 7), (lambda k: (F.col("doc_id") + 2 * k) % 3), (lambda k: 40 + (F.col("doc_id") * 7 + k) % 50)
    shift = lambda k: F.when(g(k) > 0, F.concat(F.lit(" F 0 "), g(k))).otherwise("")
    part = lambda k: F.concat(F.when(k > 0, F.concat(F.lit(" 5 0 2 I 0 "), i(k - 1), F.lit(" 3 0 2"))).otherwise(""), F.lit(" M "), m(k), F.lit(" "), 3 * m(k), shift(k))
    way = F.when(F.col("doc_id") % 2 == 0, "1000 90000 +").otherwise("100000 100 -")
    line = F.concat(F.lit("vulgar: p 0 99 . t "), way, F.lit(" 7"), F.array_join(F.transform(places, part), ""))
    hits = alignments.vulgar_hits(table(spark, d, "documents").select("doc_id", line.alias("line")), "line")
    rows = hits.select("doc_id", F.posexplode("exons").alias("exon", "x"))
    return rows.select("doc_id", (F.col("exon") + 1).alias("exon"), F.least("x.t_b", "x.t_e").alias("s"), F.greatest("x.t_b", "x.t_e").alias("e"), "x.q_b", "x.q_e", "x.gap")


_REV = "reverse(translate({x}, 'ACGT', 'TGCA'))"
_CODONS = _GENES + f"""tq AS (SELECT tx, strand, seqid, seq AS contig, min(s) AS s, max(e) AS e, string_agg(substr(seq, s, e - s + 1), '' ORDER BY s) AS t FROM ex JOIN seqs USING (seqid) GROUP BY tx, strand, seqid, seq HAVING max(e) <= length(seq)),
    tr AS (SELECT tx, strand, seqid, s, e, contig, CASE WHEN strand > 0 THEN t ELSE {_REV.format(x="t")} END AS seq, 30::BIGINT AS o, 31 + 3 * ((length(t) - 60) // 3) AS n FROM tq WHERE length(t) >= 90),
    ts AS (SELECT *, substr(seq, n::INT) || CASE WHEN strand > 0 THEN substr(contig, (e + 1)::INT) ELSE {_REV.format(x="left(contig, (s - 1)::INT)")} END AS a,
      CASE WHEN strand > 0 THEN left(contig, (s - 1)::INT) ELSE {_REV.format(x="substr(contig, (e + 1)::INT)")} END || left(seq, o::INT) AS u, substr(seq, (n - 3)::INT, 3) IN ('TAA', 'TAG', 'TGA') AS p0, substr(seq, (o + 1)::INT, 3) = 'ATG' AS q0 FROM tr),
    tc AS (SELECT *, list_filter(list_transform(range(1, length(a) // 3 + 1), lambda k: CASE WHEN substr(a, 3 * k - 2, 3) IN ('TAA', 'TAG', 'TGA') THEN k END), lambda k: k IS NOT NULL)[1] * 3 AS fa,
      list_filter(list_transform(range(1, length(u) // 3 + 1), lambda k: CASE substr(u, length(u) - 3 * k + 1, 3) WHEN 'ATG' THEN k WHEN 'TAA' THEN -k WHEN 'TAG' THEN -k WHEN 'TGA' THEN -k END), lambda k: k IS NOT NULL)[1] * 3 AS fb,
      list_filter(list_transform(range(1, (length(seq) - o) // 3), lambda k: CASE substr(seq, (o + 3 * k + 1)::INT, 3) WHEN 'ATG' THEN k WHEN 'TAA' THEN -k WHEN 'TAG' THEN -k WHEN 'TGA' THEN -k END), lambda k: k IS NOT NULL)[1] * 3 AS fi FROM ts),
    td AS (SELECT *, CASE WHEN p0 OR fa IS NULL THEN n ELSE n + fa END AS n1, CASE WHEN q0 THEN o WHEN fb > 0 THEN o - fb WHEN fi > 0 THEN o + fi ELSE o END AS o1 FROM tc),
    te AS (SELECT *, greatest(n1 - 1 - length(seq), 0) AS mo, greatest(-o1, 0) AS be FROM td)"""


def _transcripts(spark, d):
    """Models that lie on their contig's sequence, of 90 bases at least, with a coding span 30 bases from both ends, in whole codons."""
    exons = _parts(spark, d)[0]
    rows = exons.join(A.seqs(spark, d).select("seqid", F.col("seq").alias("contig")), "seqid").where("e <= length(contig)")
    pieces = rows.select(*TK, "s", "e", F.expr("substring(contig, cast(s as int), cast(e - s + 1 as int))").alias("t"))
    n = exons.groupBy(*TK).agg(F.count("*").alias("n"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "t"))), lambda x: x["t"]), "")
    whole = pieces.groupBy(*TK).agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("k"), text.alias("t")).join(n, TK).where("n = k and length(t) >= 90")
    seq = F.when(F.col("strand") > 0, F.col("t")).otherwise(sequences.reverse_complement(F.col("t")))
    return whole.select(*TK, "s", "e", seq.alias("seq"), F.lit(30).cast("long").alias("offset"), F.expr("31 + 3 * ((length(t) - 60) div 3)").alias("end"))


@query(*_after("feat feat_q seqs", _CODONS, """SELECT tx, seqid, strand, s - CASE WHEN strand > 0 THEN be ELSE mo END AS s, e + CASE WHEN strand > 0 THEN mo ELSE be END AS e, o1 + be AS "offset", n1 + be AS "end", q0 OR coalesce(fb > 0, false) OR coalesce(fi > 0, false) AS has_start, p0 OR fa IS NOT NULL AS has_stop FROM te"""))
def codon_walk(spark, d):
    """Models walked out to a stop codon and back to a start codon, beyond their ends where need be."""
    size = 20_000
    chunks = stored(frames.chunked(A.seqs(spark, d).select("seqid", "seq"), size))
    return codons.adjusted(stored(_transcripts(spark, d)), chunks, size)


@query(*_after("feat feat_q seqs", _BAGS + """cu AS (SELECT seqid, strand, min(s) AS s, max(e) AS e FROM (SELECT *, sum(nw) OVER (PARTITION BY seqid, strand ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY seqid, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 1 ELSE 0 END AS nw FROM bb)) GROUP BY seqid, strand, g),
    cn AS (SELECT *, e + 1 AS b, lead(s) OVER (PARTITION BY seqid, strand ORDER BY s) - 3 AS t FROM cu),
    cp AS (SELECT cn.*, CASE WHEN strand > 0 THEN substr(seq, b, t - b + 1) ELSE reverse(translate(substr(seq, b, t - b + 1), 'ACGT', 'TGCA')) END AS x FROM cn JOIN seqs USING (seqid) WHERE t - b + 1 >= 15 AND t <= length(seq)),
    cr AS (SELECT seqid, strand, s FROM cp WHERE list_bool_or(list_transform([0, 1, 2], lambda f: NOT list_has_any(list_transform(range(f + 1, length(x) - 1, 3), lambda i: substr(x, i, 3)), ['TAA', 'TAG', 'TGA'])))),
    cm AS (SELECT cu.*, CASE WHEN lag(cr.s) OVER (PARTITION BY cu.seqid, cu.strand ORDER BY cu.s) IS NULL THEN 1 ELSE 0 END AS nw FROM cu LEFT JOIN cr USING (seqid, strand, s))""",
    "SELECT seqid, strand, s, e, sum(nw) OVER (PARTITION BY seqid, strand ORDER BY s ROWS UNBOUNDED PRECEDING)::BIGINT AS joined FROM cm"))
def clusters_by_frame(spark, d):
    """C11: clusters of reads joined over gaps that read through; gaps of at least 15 bases here, as contigs are crowded."""
    size = 2000
    pieces = intervals.merge(_bags(spark, d), SK).select(*SK, "s", "e")
    chunks = stored(frames.chunked(A.seqs(spark, d).select("seqid", "seq"), size))
    return frames.joined_by_frame(pieces, chunks, size, 15)


@query("feat", """SELECT concat('p', seqid) AS query, concat('s', id) AS subject, round(score) AS score, round(score) / 2 AS bits, (e - s + 1)::BIGINT AS identical, strand AS s_strand, s AS q_s, e AS q_e, 1::BIGINT AS s_s, (e - s + 1)::BIGINT AS s_e FROM feat""")
def blast_round_trip(spark, d):
    """Features written as text reports, a record per contig, and read back as aligned blocks."""
    f = A.feat(spark, d)
    n = F.col("e") - F.col("s") + 1
    plus = F.col("strand") > 0
    score = F.round("score").cast("long")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    line = lambda name, b, e: text(f"{name}  ", b, "  ", F.repeat(F.lit("A"), n.cast("int")), "  ", e, "\n")
    hit = text(">s", F.col("id"), " x\nLength=", n, "\n\n Score = ", F.format_string("%.1f", score / 2), " bits (", score, "),  Expect = 1e-05\n Identities = ", n, "/", n, " (100%)\n Strand=Plus/", F.when(plus, "Plus").otherwise("Minus"), "\n\n")
    both = F.concat(line("Query", F.col("s"), F.col("e")), line("Sbjct", F.when(plus, 1).otherwise(n), F.when(plus, n).otherwise(1)), F.lit("\n"))
    records = f.groupBy("seqid").agg(F.array_join(F.collect_list(F.concat(hit, both)), "").alias("hits")).select(text(" p", F.col("seqid"), "\n\nLength=9999\n\n", F.col("hits")).alias("record"))
    return blast.parsed(records, "record").select("query", "subject", "score", "bits", "identical", "s_strand", "q_s", "q_e", "s_s", "s_e")
