"""Queries of coverage scores, quality indices and filters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.operators import intervals, scores
from locusframe.plans.interval_queries import SK, _after, _pieces
from locusframe.plans.registry import query
from locusframe.sources import adapters as A

_SIDES = """m AS (SELECT hit, seqid, strand, s, e FROM hsps WHERE hit % 5 = 0), v AS (SELECT seqid, strand, s, e FROM hsps WHERE hit % 5 <> 0), """
_TWO = _SIDES + _pieces("m", "seqid, strand").replace("_o AS", "_mo AS").replace("FROM _o", "FROM _mo").replace("_i AS", "_mi AS").replace("FROM _i", "FROM _mi").replace("pieces AS", "mp AS") + ", " + _pieces("v", "seqid, strand").replace("pieces AS", "vp AS") + """,
    ml AS (SELECT seqid, strand, sum(e - s + 1) AS n FROM mp GROUP BY ALL), vl AS (SELECT seqid, strand, sum(e - s + 1) AS n FROM vp GROUP BY ALL),
    sh AS (SELECT mp.seqid, mp.strand, sum(least(mp.e, vp.e) - greatest(mp.s, vp.s) + 1) AS n FROM mp JOIN vp ON mp.seqid = vp.seqid AND mp.strand = vp.strand AND mp.s <= vp.e AND vp.s <= mp.e GROUP BY ALL),
    sc AS (SELECT ml.seqid, ml.strand, coalesce(coalesce(sh.n, 0) / vl.n, 0) AS sn, coalesce(sh.n, 0) / ml.n AS sp FROM ml LEFT JOIN vl USING (seqid, strand) LEFT JOIN sh USING (seqid, strand))"""


def _sides(spark, d):
    h = A.hsps(spark, d)
    return h.where("hit % 5 = 0"), h.where("hit % 5 <> 0")


@query(*_after("feat hsps", _TWO, "SELECT seqid, strand, round(sn, 6) AS sn, round(sp, 6) AS sp FROM sc"))
def sn_sp(spark, d):
    m, v = _sides(spark, d)
    return scores.agreement(m, v, SK).select(*SK, F.round("sn", 6).alias("sn"), F.round("sp", 6).alias("sp"))


@query(*_after("feat hsps", _TWO, "SELECT seqid, strand, round(1 - (sn + sp) / 2, 6) AS aed FROM sc"))
def aed(spark, d):
    m, v = _sides(spark, d)
    return scores.agreement(m, v, SK).select(*SK, F.round("aed", 6).alias("aed"))


@query(*_after("feat hsps", _TWO + """, bins AS (SELECT unnest(range(0, 21)) / 20 AS bin)""", "SELECT round(bin, 2) AS bin, round(avg(CASE WHEN 1 - (sn + sp) / 2 <= bin + 1e-9 THEN 1.0 ELSE 0 END), 3) AS share FROM bins, sc GROUP BY bin"))
def aed_cdf(spark, d):
    """The share of models at or under each bin; one pass of 21 conditional means."""
    m, v = _sides(spark, d)
    found = scores.agreement(m, v, SK)
    bins = [i / 20 for i in range(21)]
    row = found.agg(*[F.avg(F.when(F.col("aed") <= b + 1e-9, 1.0).otherwise(0.0)).alias(f"b{i}") for i, b in enumerate(bins)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(round(b, 2)).alias("bin"), F.round(f"b{i}", 3).alias("share")) for i, b in enumerate(bins)])).alias("x")).select("x.*")


@query(*_after("feat hsps", _pieces("hsps", "hit, strand"), "SELECT hit, strand, sum(e - s + 1)::BIGINT AS bases FROM pieces GROUP BY hit, strand"))
def aligned_length(spark, d):
    return scores.covered(A.hsps(spark, d), ["hit", "strand"])


@query(*_after("feat", _pieces("feat", "okey"), "SELECT okey, sum(e - s + 1)::BIGINT AS bases FROM pieces GROUP BY okey"))
def exonic_bases(spark, d):
    return scores.covered(A.feat(spark, d), ["okey"])


@query(*_after("feat hsps", _pieces("hsps", "hit"), """, t AS (SELECT hit, sum(e - s + 1) AS total FROM hsps GROUP BY hit), u AS (SELECT hit, sum(e - s + 1) AS bases FROM pieces GROUP BY hit)
    SELECT hit, round(total / bases, 6) AS coverage FROM t JOIN u USING (hit) WHERE total / bases <= 3.0"""))
def complexity(spark, d):
    return scores.stacked_coverage(A.hsps(spark, d), ["hit"]).where("coverage <= 3.0").select("hit", F.round("coverage", 6).alias("coverage"))


@query("feat hsps", "SELECT hit, strand, e AS s, nx AS e FROM (SELECT *, lead(s) OVER (PARTITION BY hit, strand ORDER BY s, e) AS nx FROM hsps) WHERE nx IS NOT NULL")
def introns(spark, d):
    return scores.introns(A.hsps(spark, d), ["hit", "strand"])


@query("feat hsps", "SELECT hit, strand, e + 1 AS s, nx - 1 AS e FROM (SELECT *, lead(s) OVER (PARTITION BY hit, strand ORDER BY s, e) AS nx FROM hsps) WHERE nx - 1 > e + 1")
def introns_exclusive(spark, d):
    return scores.introns(A.hsps(spark, d), ["hit", "strand"], exclusive=True)


@query("feat hsps", """SELECT hit, strand, part, min(s) AS s, max(e) AS e, count(*) AS n FROM (
    SELECT *, sum(w) OVER (PARTITION BY hit, strand ORDER BY s, e ROWS UNBOUNDED PRECEDING)::BIGINT AS part FROM (
      SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY hit, strand ORDER BY s, e) > 500 THEN 1 ELSE 0 END AS w FROM hsps)) GROUP BY hit, strand, part""")
def split_on_gap(spark, d):
    parts = scores.split_on_gap(A.hsps(spark, d), ["hit", "strand"], 500)
    return parts.groupBy("hit", "strand", "part").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"))


@query("feat hsps", "SELECT hit, strand, min(s) AS s, max(e) AS e, count(*) AS n, sum(e - s + 1)::BIGINT AS total, round(max(score), 2) AS best FROM hsps GROUP BY hit, strand")
def hit_span(spark, d):
    return A.hsps(spark, d).groupBy("hit", "strand").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"), F.sum(F.col("e") - F.col("s") + 1).alias("total"), F.round(F.max("score"), 2).alias("best"))


@query("feat hsps hits", "SELECT hit, strand, n FROM hits WHERE n > 1")
def purge_single(spark, d):
    return A.hits(spark, d).where("n > 1").select("hit", "strand", "n")


@query("feat hsps hits", "SELECT hit, strand, n, e - s + 1 AS length FROM hits WHERE n > 1 OR e - s + 1 >= 25")
def purge_short_single(spark, d):
    return A.hits(spark, d).where("n > 1 or e - s + 1 >= 25").select("hit", "strand", "n", (F.col("e") - F.col("s") + 1).alias("length"))


_QM = """, m AS (SELECT * FROM hsps_q WHERE hit % 5 = 0), v AS (SELECT * FROM hsps_q WHERE hit % 5 <> 0),
    mi AS (SELECT hit, seqid, strand, e AS s, nx AS e FROM (SELECT *, lead(s) OVER (PARTITION BY hit, strand ORDER BY s, e, id) AS nx FROM m) WHERE nx IS NOT NULL),
    vi AS (SELECT DISTINCT seqid, strand, e AS s, nx AS e FROM (SELECT *, lead(s) OVER (PARTITION BY hit, strand ORDER BY s, e, id) AS nx FROM v) WHERE nx IS NOT NULL)"""


def _exact(spark, d):
    h = A.hsps(spark, d, exact=True)
    return h.where("hit % 5 = 0"), h.where("hit % 5 <> 0")


@query("feat feat_q hsps_q", _QM + "SELECT hit, strand, count(*) AS exons, count_if(EXISTS (SELECT 1 FROM v WHERE v.seqid = m.seqid AND v.strand = m.strand AND v.s = m.s AND v.e = m.e)) AS confirmed FROM m GROUP BY hit, strand")
def qi_confirm_exons(spark, d):
    m, v = _exact(spark, d)
    known = v.select("seqid", "strand", "s", "e").distinct().withColumn("hit_", F.lit(1))
    return m.join(known, ["seqid", "strand", "s", "e"], "left").groupBy("hit", "strand").agg(F.count("*").alias("exons"), F.count("hit_").alias("confirmed"))


def _introns(h):
    order = Window.partitionBy("hit", "strand").orderBy("s", "e", "id")
    return h.select("hit", "seqid", "strand", F.col("e").alias("s"), F.lead("s").over(order).alias("e")).where("e is not null")


@query("feat feat_q hsps_q", _QM + "SELECT hit, strand, count(*) AS introns, count_if(EXISTS (SELECT 1 FROM vi WHERE vi.seqid = mi.seqid AND vi.strand = mi.strand AND vi.s = mi.s AND vi.e = mi.e)) AS confirmed FROM mi GROUP BY hit, strand")
def qi_confirm_splices(spark, d):
    m, v = _exact(spark, d)
    known = _introns(v).select("seqid", "strand", "s", "e").distinct().withColumn("hit_", F.lit(1))
    return _introns(m).join(known, ["seqid", "strand", "s", "e"], "left").groupBy("hit", "strand").agg(F.count("*").alias("introns"), F.count("hit_").alias("confirmed"))


@query("feat hsps", """, m AS (SELECT * FROM hsps WHERE hit % 5 = 0), v AS (SELECT * FROM hsps WHERE hit % 5 <> 0)
    SELECT hit, strand, count(*) AS exons, count_if(EXISTS (SELECT 1 FROM v WHERE v.seqid = m.seqid AND v.strand = m.strand AND v.s <= m.e AND m.s <= v.e)) AS overlapped FROM m GROUP BY hit, strand""")
def qi_overlap(spark, d):
    m, v = _sides(spark, d)
    met = intervals.overlap_join(m, v.select(*SK, "s", "e"), SK, how="left_semi").groupBy("hit", "strand").agg(F.count("*").alias("overlapped"))
    return m.groupBy("hit", "strand").agg(F.count("*").alias("exons")).join(met, ["hit", "strand"], "left").select("hit", "strand", "exons", F.coalesce("overlapped", F.lit(0)).alias("overlapped"))


_CUT = "CASE WHEN {d} = 0 THEN -1 ELSE floor({n} / {d} * 100 + 1e-9) / 100 END"


@query("feat feat_q hsps_q", _QM + f""",
    ex AS (SELECT hit, strand, count(*) AS n, count_if(EXISTS (SELECT 1 FROM v WHERE v.seqid = m.seqid AND v.strand = m.strand AND v.s = m.s AND v.e = m.e)) AS c,
      count_if(EXISTS (SELECT 1 FROM v WHERE v.seqid = m.seqid AND v.strand = m.strand AND v.s <= m.e AND m.s <= v.e)) AS o FROM m GROUP BY hit, strand),
    sp AS (SELECT hit, strand, count(*) AS n, count_if(EXISTS (SELECT 1 FROM vi WHERE vi.seqid = mi.seqid AND vi.strand = mi.strand AND vi.s = mi.s AND vi.e = mi.e)) AS c FROM mi GROUP BY hit, strand)
    SELECT hit, strand, {_CUT.format(n='coalesce(sp.c, 0)', d='coalesce(sp.n, 0)')}::DOUBLE AS splices, {_CUT.format(n='ex.c', d='ex.n')}::DOUBLE AS exons, {_CUT.format(n='ex.o', d='ex.n')}::DOUBLE AS overlapped, ex.n AS n_exons FROM ex LEFT JOIN sp USING (hit, strand)""")
def quality_index(spark, d):
    """The quality index's fractions, cut to two decimals; -1 for the splices of a single exon."""
    m, v = _exact(spark, d)
    exons, splices = qi_confirm_exons(spark, d), qi_confirm_splices(spark, d).withColumnRenamed("confirmed", "spliced")
    met = intervals.overlap_join(m, v.select(*SK, "s", "e"), SK, how="left_semi").groupBy("hit", "strand").agg(F.count("*").alias("met"))
    both = exons.join(splices, ["hit", "strand"], "left").join(met, ["hit", "strand"], "left")
    return both.select(
        "hit", "strand", F.coalesce(scores.truncated(F.col("spliced") / F.col("introns")), F.lit(-1.0)).cast("double").alias("splices"),
        scores.truncated(F.col("confirmed") / F.col("exons")).cast("double").alias("exons"),
        scores.truncated(F.coalesce("met", F.lit(0)) / F.col("exons")).cast("double").alias("overlapped"), F.col("exons").alias("n_exons"),
    )


@query("feat hsps hits", """SELECT hit, strand, rank FROM (SELECT hit, strand, row_number() OVER (PARTITION BY seqid ORDER BY bases DESC, n DESC, score DESC, hit, strand) AS rank FROM hits) WHERE rank <= 5""")
def rank_genes(spark, d):
    w = Window.partitionBy("seqid").orderBy(F.desc("bases"), F.desc("n"), F.desc("score"), "hit", "strand")
    return A.hits(spark, d).withColumn("rank", F.row_number().over(w)).where("rank <= 5").select("hit", "strand", "rank")


@query("feat hsps", """SELECT id, phase FROM (SELECT id, ((-coalesce(sum(e - s + 1) OVER (PARTITION BY hit, strand ORDER BY s * strand, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) % 3 + 3) % 3 AS phase FROM hsps)""".replace("SELECT id, phase FROM", "SELECT id, phase::BIGINT AS phase FROM"))
def cds_phase(spark, d):
    h = A.hsps(spark, d)
    order = Window.partitionBy("hit", "strand").orderBy(F.col("s") * F.col("strand"), "e", "id").rowsBetween(Window.unboundedPreceding, -1)
    return h.select("id", F.pmod(-F.coalesce(F.sum(F.col("e") - F.col("s") + 1).over(order), F.lit(0)), F.lit(3)).cast("long").alias("phase"))


@query("feat hsps", "SELECT id, coalesce(sum(e - s + 1) OVER (PARTITION BY hit, strand ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_in_transcript FROM hsps")
def exon_start_in_transcript(spark, d):
    order = Window.partitionBy("hit", "strand").orderBy("s", "e", "id").rowsBetween(Window.unboundedPreceding, -1)
    return A.hsps(spark, d).select("id", F.coalesce(F.sum(F.col("e") - F.col("s") + 1).over(order), F.lit(0)).alias("start_in_transcript"))


@query("feat hsps hits", """SELECT seqid, strand, count_if(kind = 'none') AS none, count_if(kind = 'one') AS one, count_if(kind = 'many') AS many FROM (
    SELECT a.seqid, a.strand, a.hit, CASE WHEN count(b.hit) = 0 THEN 'none' WHEN count(b.hit) = 1 THEN 'one' ELSE 'many' END AS kind
    FROM hits a LEFT JOIN hits b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e AND b.hit % 5 <> 0 WHERE a.hit % 5 = 0 GROUP BY ALL) GROUP BY seqid, strand""")
def gene_set_diff(spark, d):
    """How many genes of one set meet none, one or many of the other."""
    h = A.hits(spark, d)
    met = intervals.overlap_join(h.where("hit % 5 = 0").select("hit", *SK, "s", "e"), h.where("hit % 5 <> 0").select(*SK, "s", "e", F.col("hit").alias("b_hit")), SK, bin_sizes=(64, 1024, 1 << 14)).groupBy("hit", *SK).agg(F.count("*").alias("k"))
    n = F.coalesce("k", F.lit(0))
    rows = h.where("hit % 5 = 0").join(met, ["hit", *SK], "left")
    return rows.groupBy(*SK).agg(F.count_if(n == 0).alias("none"), F.count_if(n == 1).alias("one"), F.count_if(n > 1).alias("many"))


@query("feat", """SELECT id, round(avg(score) OVER (PARTITION BY seqid ORDER BY s, e, id ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), 4) AS mean FROM feat""")
def windowed_mean(spark, d):
    w = Window.partitionBy("seqid").orderBy("s", "e", "id").rowsBetween(0, 2)
    return A.feat(spark, d).select("id", F.round(F.avg("score").over(w), 4).alias("mean"))


@query("feat hsps hits", """, pr AS (SELECT seqid, strand, hit, n, bases, lag(e) OVER (PARTITION BY seqid, strand ORDER BY s, e, hit) AS before, lead(s) OVER (PARTITION BY seqid, strand ORDER BY s, e, hit) AS after, s, e FROM hits)
    SELECT seqid, strand, hit, greatest(s, coalesce(before + 1, s)) AS s, least(e, coalesce(after - 1, e)) AS e FROM pr WHERE greatest(s, coalesce(before + 1, s)) <= least(e, coalesce(after - 1, e))""")
def clip_neighbours(spark, d):
    """Spans clipped so that they don't run into the genes before and behind."""
    w = Window.partitionBy(*SK).orderBy("s", "e", "hit")
    rows = A.hits(spark, d).select(*SK, "hit", F.greatest("s", F.coalesce(F.lag("e").over(w) + 1, "s")).alias("s"), F.least("e", F.coalesce(F.lead("s").over(w) - 1, "e")).alias("e"))
    return rows.where("s <= e")
