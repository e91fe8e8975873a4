"""Queries that compare hits by their structure."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.functions import forms
from locusframe.operators import graphs, intervals
from locusframe.plans.interval_queries import _CODE, SK, VALUE, _after, _pieces
from locusframe.plans.registry import query
from locusframe.shared import stored
from locusframe.sources import adapters as A

_BLOCKS = """, hq AS (SELECT hit, seqid, strand, min(s) AS s, max(e) AS e, count(*) AS n FROM hsps_q GROUP BY hit, seqid, strand),
    pr AS (SELECT a.seqid, a.strand, a.hit AS x, b.hit AS y, a.n AS nx, b.n AS ny FROM hq a JOIN hq b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e AND a.hit <> b.hit),
    un AS (SELECT pr.seqid, pr.strand, x, y, h.s, h.e FROM pr JOIN hsps_q h ON h.strand = pr.strand AND h.hit IN (x, y) AND h.seqid = pr.seqid),
    um AS (SELECT *, max(e) OVER (PARTITION BY seqid, strand, x, y ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM un),
    ui AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY seqid, strand, x, y ORDER BY s, e, p NULLS FIRST ROWS UNBOUNDED PRECEDING) AS i FROM um),
    pc AS (SELECT seqid, strand, x, y, i, min(s) AS s, max(e) AS e FROM ui GROUP BY ALL),"""


def _string(name: str, of: str, against: str) -> str:
    """The code string of rows `of` (seqid, strand, x, y, s, e, id) against blocks of hit `against`."""
    code = _CODE.format(x="p.s", y="p.e", p="q.s", q="q.e")
    return f"""{name}_b AS (SELECT seqid, strand, x, y, s, e, id, first(code ORDER BY v DESC, qs, qe, qid) FILTER (v > 0) AS code FROM (SELECT *, {VALUE} AS v FROM (
        SELECT p.seqid, p.strand, p.x, p.y, p.s, p.e, p.id, q.s AS qs, q.e AS qe, q.id AS qid, {code} AS code FROM ({of}) p JOIN hsps_q q ON q.hit = p.{against} AND q.strand = p.strand AND q.seqid = p.seqid)) GROUP BY ALL),
    {name} AS (SELECT seqid, strand, x, y, string_agg(coalesce(code, '0'), '' ORDER BY s, e, id) AS code FROM {name}_b GROUP BY ALL)"""


_SHADOWS = _BLOCKS + _string("sx", "SELECT *, i AS id FROM pc", "x") + "," + _string("sy", "SELECT *, i AS id FROM pc", "y")
_ALL = _SHADOWS + "," + _string("xy", "SELECT pr.*, h.s, h.e, h.id FROM pr JOIN hsps_q h ON h.hit = pr.x AND h.strand = pr.strand AND h.seqid = pr.seqid", "y") + "," + _string("yx", "SELECT pr.*, h.s, h.e, h.id FROM pr JOIN hsps_q h ON h.hit = pr.y AND h.strand = pr.strand AND h.seqid = pr.seqid", "x") + """,
    ev AS (SELECT pr.seqid, pr.strand, pr.x, pr.y, nx, ny, sx.code AS sx, sy.code AS sy, xy.code AS xy, yx.code AS yx FROM pr JOIN sx USING (seqid, strand, x, y) JOIN sy USING (seqid, strand, x, y) JOIN xy USING (seqid, strand, x, y) JOIN yx USING (seqid, strand, x, y)),
    fo AS (SELECT *, nx = ny AND ((sx = sy AND NOT regexp_matches(xy, '^0+$')) OR NOT (regexp_matches(sx, '[^0]0+[^0]') OR regexp_matches(sy, '[^0]0+[^0]') OR regexp_matches(xy, '^0+$'))) AS same,
      (sx = sy AND NOT regexp_matches(xy, '^0*$')) OR (regexp_matches(yx, '^B?1+b?$') AND regexp_matches(xy, '^0*A?1+a?0*$')) AS redundant FROM ev)"""


def _hits(spark, d):
    h = A.hsps(spark, d, exact=True)
    blocks = F.array_sort(F.collect_list(F.struct("s", "e")))
    return h.groupBy("hit", *SK).agg(blocks.alias("blocks"), F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"))


def _pairs(spark, d, both_ways: bool):
    """Pairs x, y of hits whose spans overlap, with their blocks (a, b) and numbers of blocks."""
    h = _hits(spark, d)
    right = h.select(*SK, "s", "e", F.col("hit").alias("y"), F.col("blocks").alias("b"), F.col("n").alias("ny"))
    met = intervals.overlap_join(h.select(*SK, "s", "e", F.col("hit").alias("x"), F.col("blocks").alias("a"), F.col("n").alias("nx"), F.lit(0).alias("_z")).drop("_z"), right, SK, bin_sizes=(64, 1024, 1 << 14))
    return met.where("x <> y" if both_ways else "x < y")


def _compared(pairs):
    return forms.compared(pairs, [*SK, "x", "y", "nx", "ny"])


def _same():
    return (F.col("nx") == F.col("ny")) & forms.same_codes(F.col("sx"), F.col("sy"), F.col("xy"))


def _redundant():
    return forms.redundant_codes(F.col("sx"), F.col("sy"), F.col("xy"), F.col("yx"))


@query("feat feat_q hsps_q", _SHADOWS + " SELECT seqid, strand, x, y, sx.code AS sx, sy.code AS sy FROM sx JOIN sy USING (seqid, strand, x, y) WHERE x < y")
def shadow_codes(spark, d):
    """C0d, C0e: the codes of two hits' merged pieces against each."""
    return _compared(_pairs(spark, d, False)).select(*SK, "x", "y", "sx", "sy")


@query("feat feat_q hsps_q", _ALL + " SELECT seqid, strand, x, y, same FROM fo WHERE x < y")
def same_forms(spark, d):
    """C0f"""
    return _compared(_pairs(spark, d, False)).select(*SK, "x", "y", _same().alias("same"))


@query("feat feat_q hsps_q", _ALL + " SELECT seqid, strand, x, y, redundant FROM fo")
def redundant_pairs(spark, d):
    """C0g: whether x says nothing that y doesn't."""
    return _compared(_pairs(spark, d, True)).select(*SK, "x", "y", _redundant().alias("redundant"))


def _greedy_sql(kind: str) -> str:
    return _ALL + f""", rk AS (SELECT seqid, strand, hit, row_number() OVER (PARTITION BY seqid, strand ORDER BY n DESC, e - s DESC, hit) AS r FROM hq),
    dm AS (SELECT rk.seqid, rk.strand, rk.hit, rk.r, coalesce(list(fo.y) FILTER (fo.y IS NOT NULL), []) AS others FROM rk LEFT JOIN fo ON fo.seqid = rk.seqid AND fo.strand = rk.strand AND fo.x = rk.hit AND fo.{kind} GROUP BY ALL),
    go AS (SELECT seqid, strand, 1 AS r, [hit] AS kept FROM dm WHERE r = 1
      UNION ALL SELECT go.seqid, go.strand, go.r + 1, CASE WHEN len(list_intersect(kept, others)) = 0 THEN list_append(kept, dm.hit) ELSE kept END FROM go JOIN dm ON dm.seqid = go.seqid AND dm.strand = go.strand AND dm.r = go.r + 1)
    SELECT seqid, strand, unnest(kept) AS hit FROM (SELECT *, max(r) OVER (PARTITION BY seqid, strand) AS last FROM go) WHERE r = last"""


def _kept(spark, d, test):
    """Hits in order of blocks and length that no kept hit rules out, within islands of spans, which no pair crosses."""
    h = _hits(spark, d)
    ruled = _compared(_pairs(spark, d, True)).where(test()).groupBy(*SK, F.col("x").alias("hit")).agg(F.collect_list("y").alias("others"))
    rows = intervals.islands(h.select("hit", *SK, "s", "e", "n"), SK, name="part").join(ruled, ["hit", *SK], "left")
    rank = F.row_number().over(Window.partitionBy(*SK, "part").orderBy(F.desc("n"), F.desc(F.col("e") - F.col("s")), "hit"))
    return graphs.greedy(rows.withColumn("rank", rank), [*SK, "part"], "rank", "hit", "others").select(*SK, "hit")


@query("feat feat_q hsps_q", _greedy_sql("redundant"))
def redundant_forms(spark, d):
    """Hits that are left when those go that say nothing new to a kept one."""
    return _kept(spark, d, _redundant)


@query("feat feat_q hsps_q", _greedy_sql("same"))
def distinct_forms(spark, d):
    """One hit of each alternative form."""
    return _kept(spark, d, _same)


@query("feat feat_q hsps_q", """, st AS (SELECT hit, seqid, strand, string_agg(s || '-' || e, ',' ORDER BY s, e) AS form FROM hsps_q GROUP BY ALL)
    SELECT hit, seqid, strand, min(hit) OVER (PARTITION BY seqid, strand, form) AS first, count(*) OVER (PARTITION BY seqid, strand, form) AS alike FROM st""")
def identical_forms(spark, d):
    """C0j, C0k: hits with equal blocks, named after the smallest."""
    h = A.hsps(spark, d, exact=True).groupBy("hit", *SK).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("form"))
    first = h.groupBy(*SK, "form").agg(F.min("hit").alias("first"), F.count("*").alias("alike"))
    return h.join(first, [*SK, "form"]).select("hit", *SK, "first", "alike")


@query("feat hsps", """, pairs AS (SELECT DISTINCT a.seqid, a.strand, a.hit AS x, b.hit AS y FROM hsps a JOIN hsps b ON a.seqid = b.seqid AND a.strand = b.strand AND a.hit < b.hit AND greatest(a.s - 4, 1) <= b.e AND b.s <= a.e + 4) SELECT * FROM pairs""")
def hsps_overlap(spark, d):
    """C0i: pairs of hits with blocks that overlap when the first's are widened by four."""
    h = A.hsps(spark, d)
    right = h.select(*SK, "s", "e", F.col("hit").alias("y"))
    return intervals.overlap_join(h.select(*SK, "s", "e", F.col("hit").alias("x")), right, SK, flank=4).where("x < y").select(*SK, "x", "y").distinct()


_INTRONS = """, bl AS (SELECT DISTINCT hit, seqid, strand, s, e FROM hsps_q), it AS (SELECT DISTINCT hit, seqid, strand, a AS s, b AS e FROM (SELECT hit, seqid, strand, e AS a, lead(s) OVER (PARTITION BY hit, strand ORDER BY s, e) AS b FROM bl) WHERE b > a),
    sp AS (SELECT hit, seqid, strand, min(s) AS s, max(e) AS e FROM bl GROUP BY ALL),
    pr AS (SELECT a.seqid, a.strand, a.hit AS x, b.hit AS y FROM sp a JOIN sp b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e AND a.hit < b.hit),
    bad AS (SELECT x, y, pr.strand FROM pr JOIN it ON it.hit = x AND it.strand = pr.strand JOIN sp ON sp.hit = y AND sp.strand = pr.strand AND it.s <= sp.e AND sp.s <= it.e WHERE NOT EXISTS (SELECT 1 FROM it o WHERE o.hit = y AND o.strand = pr.strand AND o.s = it.s AND o.e = it.e)
      UNION SELECT x, y, pr.strand FROM pr JOIN it ON it.hit = y AND it.strand = pr.strand JOIN sp ON sp.hit = x AND sp.strand = pr.strand AND it.s <= sp.e AND sp.s <= it.e WHERE NOT EXISTS (SELECT 1 FROM it o WHERE o.hit = x AND o.strand = pr.strand AND o.s = it.s AND o.e = it.e))
    SELECT seqid, strand, x, y, bad.x IS NULL AS agree FROM pr LEFT JOIN bad USING (x, y, strand)"""


@query("feat feat_q hsps_q", _INTRONS)
def intron_agreement(spark, d):
    """C0l: whether two hits have the same introns where they meet; an intron from an end to the next begin counts if it meets the other's span."""
    blocks = A.hsps(spark, d, exact=True).select("hit", *SK, "s", "e").distinct()
    order = Window.partitionBy("hit", "strand").orderBy("s", "e")
    introns = blocks.select("hit", *SK, F.col("e").alias("s"), F.lead("s").over(order).alias("e")).where("e > s").distinct()
    spans = blocks.groupBy("hit", *SK).agg(F.min("s").alias("s"), F.max("e").alias("e"))
    right = spans.select(*SK, "s", "e", F.col("hit").alias("y"))
    bins = (64, 1024, 1 << 14)
    pairs = intervals.overlap_join(spans.select(*SK, "s", "e", F.col("hit").alias("x")), right, SK, bin_sizes=bins).where("x <> y").select(*SK, "x", "y", "bs", "be")
    # an intron of x that meets y's span and isn't one of y's
    own = pairs.join(introns.select("strand", F.col("hit").alias("x"), "s", "e"), ["x", "strand"]).where("s <= be and bs <= e")
    bad = own.join(introns.select("strand", F.col("hit").alias("y"), "s", "e"), ["y", "strand", "s", "e"], "left_anti").select("strand", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct().withColumn("bad", F.lit(True))
    return pairs.where("x < y").join(bad, ["strand", "x", "y"], "left").select(*SK, "x", "y", F.col("bad").isNull().alias("agree"))


_SPLIT = """, nd AS (SELECT *, hit * 2 + CASE WHEN strand > 0 THEN 0 ELSE 1 END AS node FROM hits),
    ed AS MATERIALIZED (SELECT DISTINCT a.node AS x, b.node AS y FROM nd a JOIN nd b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e AND a.node < b.node),
    us AS MATERIALIZED (SELECT DISTINCT hit * 2 + CASE WHEN strand > 0 THEN 0 ELSE 1 END AS node, unnest(range(s, e + 1)) AS p FROM hsps), ln AS MATERIALIZED (SELECT node, count(*) AS n FROM us GROUP BY node),
    xb AS MATERIALIZED (SELECT x, y, p FROM ed JOIN us ON node = x), sh AS MATERIALIZED (SELECT x, y, count(*) AS n FROM xb JOIN us b ON b.node = y AND b.p = xb.p GROUP BY x, y),
    eg AS MATERIALIZED (SELECT x, y FROM sh JOIN ln a ON a.node = x JOIN ln b ON b.node = y WHERE sh.n / a.n >= 0.5 OR sh.n / b.n >= 0.5),
    bo AS MATERIALIZED (SELECT x, y FROM eg UNION ALL SELECT y, x FROM eg), dg AS MATERIALIZED (SELECT x, count(*) AS d FROM bo GROUP BY x),
    wd AS MATERIALIZED (SELECT p.x, q.x AS y, count(*) AS k FROM bo p JOIN bo q ON q.y = p.y GROUP BY ALL), cm AS MATERIALIZED (SELECT eg.x, eg.y, 1 + coalesce(k, 0) AS n FROM eg LEFT JOIN wd ON wd.x = eg.x AND wd.y = eg.y),
    kp AS MATERIALIZED (SELECT cm.x, cm.y FROM cm JOIN dg a ON a.x = cm.x JOIN dg b ON b.x = cm.y WHERE n / (a.d + b.d - n) >= 0.6), kk AS MATERIALIZED (SELECT x, y FROM kp UNION ALL SELECT y, x FROM kp),
    re AS (SELECT node, node AS other FROM nd UNION SELECT re.node, kk.y FROM re JOIN kk ON kk.x = re.other), mn AS (SELECT node, min(other) // 2 AS cluster FROM re GROUP BY node)
    SELECT seqid, strand, hit, cluster FROM nd JOIN mn USING (node)"""


@query("feat hsps hits", _SPLIT)
def jaccard_split(spark, d):
    """Hits whose bases agree by half either way are neighbours; neighbours with enough common ones make a cluster."""
    from locusframe.operators import clusters

    h, n = A.hsps(spark, d), A.n_feat(spark, d)
    pieces = stored(intervals.merge(h, ["hit", *SK], rows=n).select("hit", *SK, "s", "e"))
    size = pieces.groupBy("hit", "strand").agg(F.sum(F.col("e") - F.col("s") + 1).alias("n"))
    met = intervals.overlap_join(pieces.withColumnRenamed("hit", "x"), pieces.withColumnRenamed("hit", "y"), SK).where("x < y")
    shared = met.groupBy(*SK, "x", "y").agg(F.sum(F.least("e", "be") - F.greatest("s", "bs") + 1).alias("shared"))
    sized = shared.join(size.select("strand", F.col("hit").alias("x"), F.col("n").alias("nx")), ["strand", "x"]).join(size.select("strand", F.col("hit").alias("y"), F.col("n").alias("ny")), ["strand", "y"])
    edges = stored(sized.where((F.col("shared") / F.col("nx") >= 0.5) | (F.col("shared") / F.col("ny") >= 0.5)).select(*SK, "x", "y"))
    kept = clusters.jaccard_edges(edges, SK, 0.6)
    # a hit has a node for each strand
    node = lambda c: F.col(c) * 2 + F.when(F.col("strand") > 0, 0).otherwise(1)
    found = graphs.components(size.select(node("hit").alias("node")), kept.select(node("x").alias("x"), node("y").alias("y")))
    named = found.select(F.expr("node div 2").alias("hit"), F.when(F.col("node") % 2 == 0, 1).otherwise(-1).alias("strand"), F.expr("component div 2").alias("cluster"))
    return named.join(h.select("hit", *SK).distinct(), ["hit", "strand"]).select(*SK, "hit", "cluster")


_CAREFUL = _pieces("hits", "seqid, strand", 10) + """,
    tk AS (SELECT hit, seqid, strand, island FROM (SELECT *, row_number() OVER (PARTITION BY seqid, strand, island ORDER BY bases DESC, score DESC, hit) AS r FROM _i) WHERE r <= 3),
    bk AS (SELECT h.* FROM hsps h JOIN tk USING (hit, seqid, strand)),
    ed AS (SELECT DISTINCT a.seqid, a.strand, a.hit AS x, b.hit AS y FROM bk a JOIN bk b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e),
    re AS (SELECT seqid, strand, x AS node, y AS other FROM ed UNION SELECT r.seqid, r.strand, r.node, ed.y FROM re r JOIN ed ON ed.seqid = r.seqid AND ed.strand = r.strand AND ed.x = r.other)"""


@query(*_after("feat hsps hits", _CAREFUL, "SELECT seqid, strand, node AS hit, min(other) AS cluster FROM re GROUP BY ALL"))
def careful_clusters(spark, d):
    """The first three hits of every shadow cluster, then components of what their blocks share."""
    from locusframe.operators import clusters

    h = A.hsps(spark, d)
    top = clusters.shadow_clusters(A.hits(spark, d), SK, [F.desc("bases"), F.desc("score"), F.col("hit")], 3, 10).select("hit", *SK, F.col("cluster").alias("part"))
    return clusters.components_in_groups(h.join(top, ["hit", *SK]), [*SK, "part"], "hit").select(*SK, "hit", F.col("component").alias("cluster"))
