"""Queries of the interval core: merging, comparing, joining, clustering, selecting."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.operators import clusters, intervals, selection
from locusframe.plans.registry import query, table
from locusframe.sources import adapters as A


def _pieces(source: str, keys: str, flank: int = 0) -> str:
    return f"""_o AS (SELECT *, max(e + {flank}) OVER (PARTITION BY {keys} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {source}),
      _i AS (SELECT *, sum(CASE WHEN p IS NULL OR s - {flank} > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY s, e, p NULLS FIRST ROWS UNBOUNDED PRECEDING) AS island FROM _o),
      pieces AS (SELECT {keys}, island, greatest(min(s) - {flank}, 1) AS s, max(e) + {flank} AS e, count(*) AS n FROM _i GROUP BY {keys}, island)"""


def _after(views: str, more: str, sql: str) -> tuple[str, str]:
    """views and SQL, with further common table expressions between."""
    return "", A.with_views(views, "").rstrip("\n") + ",\n" + more + "\n" + sql


SK = ["seqid", "strand"]


@query(*_after("feat", _pieces("feat", "seqid, strand"), "SELECT seqid, strand, count(*) AS pieces, sum(e - s + 1)::BIGINT AS bases, sum(n)::BIGINT AS features FROM pieces GROUP BY seqid, strand"))
def merge_intervals(spark, d):
    p = intervals.merge(A.feat(spark, d), SK, rows=A.n_feat(spark, d))
    return p.groupBy(*SK).agg(F.count("*").alias("pieces"), F.sum(F.col("e") - F.col("s") + 1).alias("bases"), F.sum("n").alias("features"))


@query(*_after("feat", _pieces("feat", "seqid, strand", 10), "SELECT seqid, strand, s::BIGINT AS s, e::BIGINT AS e, n FROM pieces"))
def merge_flank(spark, d):
    return intervals.merge(A.feat(spark, d), SK, flank=10, rows=A.n_feat(spark, d))


@query("", "WITH points AS (SELECT user_id AS seqid, floor(epoch(ts))::BIGINT // 60 AS s, floor(epoch(ts))::BIGINT // 60 AS e FROM events)," + _pieces("points", "seqid", 30) + " SELECT seqid, s::BIGINT AS s, e::BIGINT AS e, n FROM pieces")
def sessions_by_gap(spark, d):
    minute = F.expr("unix_timestamp(cast(ts as timestamp)) div 60")
    points = table(spark, d, "events").select(F.col("user_id").alias("seqid"), minute.alias("s"), minute.alias("e"))
    return intervals.merge(points, ["seqid"], flank=30, block=1 << 14)


_LENGTHS = """,
    l AS (SELECT seqid, max(e) + 100 AS length FROM feat GROUP BY seqid),
    n AS (SELECT *, lead(s) OVER (PARTITION BY seqid ORDER BY s) AS nx FROM pieces)"""


@query(*_after("feat", _pieces("feat", "seqid") + _LENGTHS, """
    SELECT seqid, (e + 1)::BIGINT AS s, (nx - 1)::BIGINT AS e FROM n WHERE nx > e + 1
    UNION ALL SELECT seqid, 1, (min(s) - 1)::BIGINT FROM pieces GROUP BY seqid HAVING min(s) > 1
    UNION ALL SELECT p.seqid, (max(p.e) + 1)::BIGINT, any_value(length)::BIGINT FROM pieces p JOIN l USING (seqid) GROUP BY p.seqid HAVING max(p.e) < any_value(length)"""))
def complement_gaps(spark, d):
    f = A.feat(spark, d)
    lengths = f.groupBy("seqid").agg((F.max("e") + 100).alias("length"))
    return intervals.gaps(intervals.merge(f, ["seqid"]), ["seqid"], lengths)


_CODE = """CASE WHEN {q} < {x} OR {p} > {y} THEN '0' WHEN {x} = {p} AND {y} = {q} THEN '1' WHEN {p} < {x} AND {y} = {q} THEN 'B' WHEN {x} < {p} AND {y} = {q} THEN 'A'
    WHEN {x} = {p} AND {y} < {q} THEN 'b' WHEN {x} = {p} AND {y} > {q} THEN 'a' WHEN {x} > {p} AND {y} < {q} THEN 'I' WHEN {x} < {p} AND {y} > {q} THEN 'i'
    WHEN {x} < {p} AND {y} < {q} THEN 'Z' WHEN {x} > {p} AND {y} > {q} THEN 'z' END"""
CODE = _CODE.format(x="a.s", y="a.e", p="b.s", q="b.e")
VALUE = "CASE WHEN code = '1' THEN 10 WHEN code IN ('A', 'B', 'a', 'b') THEN 5 ELSE 0 END"
MEET = "a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e"


def _b(df, *cols):
    return df.select(*SK, "s", "e", *[F.col(c).alias("b_" + c) for c in cols])


@query("feat", f"SELECT code, count(*) AS pairs FROM (SELECT {CODE} AS code FROM feat a JOIN feat b ON {MEET} AND a.id <> b.id) GROUP BY code")
def classify_overlap(spark, d):
    f = A.feat(spark, d)
    pairs = intervals.overlap_join(f, _b(f, "id"), SK).where("id <> b_id")
    return pairs.select(intervals.classify(F.col("s"), F.col("e"), F.col("bs"), F.col("be")).alias("code")).groupBy("code").agg(F.count("*").alias("pairs"))


@query("feat feat_q", f"SELECT code, count(*) AS pairs FROM (SELECT {CODE} AS code FROM feat_q a JOIN feat_q b ON {MEET} AND a.id <> b.id) GROUP BY code")
def classify_overlap_snapped(spark, d):
    f = A.feat_q(spark, d)
    pairs = intervals.overlap_join(f, _b(f, "id"), SK).where("id <> b_id")
    return pairs.select(intervals.classify(F.col("s"), F.col("e"), F.col("bs"), F.col("be")).alias("code")).groupBy("code").agg(F.count("*").alias("pairs"))


@query("feat hsps", f"""SELECT hit, other, string_agg(code, '' ORDER BY s, e, id) AS codes FROM (
    SELECT a.hit, b.other, a.s, a.e, a.id, coalesce(first(code ORDER BY {VALUE} DESC, bs, be, bid), '0') AS code FROM (SELECT * FROM hsps) a JOIN (
      SELECT DISTINCT a.hit, b.hit AS other, a.seqid, a.strand FROM hsps a JOIN hsps b ON {MEET} AND a.hit < b.hit) b ON a.hit = b.hit AND a.seqid = b.seqid AND a.strand = b.strand
    LEFT JOIN (SELECT id, other, CASE WHEN {VALUE} > 0 THEN code ELSE '0' END AS code, bs, be, bid FROM (SELECT a.id, b.hit AS other, b.s AS bs, b.e AS be, b.id AS bid, {CODE} AS code FROM hsps a JOIN hsps b ON {MEET} AND a.hit < b.hit)) c
      ON c.id = a.id AND c.other = b.other GROUP BY a.hit, b.other, a.s, a.e, a.id) GROUP BY hit, other""")
def hsp_code_string(spark, d):
    """Per pair of hits, one character per block of the first: the most telling code against the second's blocks."""
    h = A.hsps(spark, d)
    pairs = intervals.overlap_join(h, _b(h, "hit", "id"), SK).where("hit < b_hit")
    code = intervals.classify(F.col("s"), F.col("e"), F.col("bs"), F.col("be"))
    best = pairs.withColumn("code", code).withColumn("v", intervals.code_value(F.col("code"))).groupBy("hit", "b_hit", "seqid", "strand", "id").agg(F.min(F.struct((-F.col("v")).alias("v"), "bs", "be", "b_id", "code")).alias("m"))
    best = best.select("hit", "b_hit", "seqid", "strand", "id", F.when(F.col("m.v") < 0, F.col("m.code")).otherwise("0").alias("code"))
    met = best.select("hit", "b_hit", "seqid", "strand").distinct()
    blocks = h.join(met, ["hit", "seqid", "strand"]).join(best, ["hit", "b_hit", "seqid", "strand", "id"], "left")
    row = F.struct("s", "e", "id", F.coalesce("code", F.lit("0")).alias("code"))
    return blocks.groupBy("hit", F.col("b_hit").alias("other")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["code"]), "").alias("codes"))


@query("feat", f"SELECT a.seqid, a.strand, count(*) AS pairs, sum(least(a.e, b.e) - greatest(a.s, b.s) + 1)::BIGINT AS shared FROM feat a JOIN feat b ON {MEET} AND a.id < b.id GROUP BY a.seqid, a.strand")
def overlap_join(spark, d):
    f = A.feat(spark, d)
    pairs = intervals.overlap_join(f, _b(f, "id"), SK).where("id < b_id")
    return pairs.groupBy(*SK).agg(F.count("*").alias("pairs"), F.sum(F.least("e", "be") - F.greatest("s", "bs") + 1).alias("shared"))


@query("feat", "SELECT a.seqid, count(*) AS pairs FROM feat a JOIN feat b ON a.seqid = b.seqid AND a.s - 3 <= b.e AND b.s <= a.e + 3 AND a.id < b.id GROUP BY a.seqid")
def overlap_any_strand(spark, d):
    f = A.feat(spark, d)
    other = f.select("seqid", "s", "e", F.col("id").alias("b_id"))
    return intervals.overlap_join(f.drop("strand"), other, ["seqid"], flank=3).where("id < b_id").groupBy("seqid").agg(F.count("*").alias("pairs"))


@query("feat", "SELECT id, seqid, s, e FROM feat a WHERE source = 'R' AND NOT EXISTS (SELECT 1 FROM feat b WHERE b.source <> 'R' AND a.seqid = b.seqid AND a.s - 5 <= b.e AND b.s <= a.e + 5)")
def overlap_anti(spark, d):
    f = A.feat(spark, d)
    return selection.unsupported(f.where("source = 'R'"), f.where("source <> 'R'").select("seqid", "s", "e"), ["seqid"], 5).select("id", "seqid", "s", "e")


@query("feat", f"SELECT hit, id, rank FROM (SELECT a.id AS hit, b.id, row_number() OVER (PARTITION BY a.id ORDER BY b.s, b.e, b.id) AS rank FROM feat a JOIN feat b ON {MEET} AND a.id <> b.id WHERE a.source = 'R') WHERE rank <= 3")
def overlap_depth(spark, d):
    f = A.feat(spark, d)
    pairs = intervals.overlap_join(f.where("source = 'R'"), _b(f, "id"), SK).where("id <> b_id")
    w = Window.partitionBy("id").orderBy("bs", "be", "b_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where("rank <= 3").select(F.col("id").alias("hit"), F.col("b_id").alias("id"), "rank")


@query(*_after("feat", "ev AS (SELECT * FROM feat WHERE source <> 'R'), " + _pieces("ev", "seqid, strand", 5), """
    SELECT f.id, CASE WHEN count(p.island) = 0 THEN 'none' WHEN count(p.island) = 1 THEN 'one' ELSE 'many' END AS kind
    FROM feat f LEFT JOIN pieces p ON f.seqid = p.seqid AND f.strand = p.strand AND f.s <= p.e AND p.s <= f.e WHERE f.source = 'R' GROUP BY f.id"""))
def multiplicity(spark, d):
    f = A.feat(spark, d)
    pieces = intervals.merge(f.where("source <> 'R'"), SK, 5).withColumn("piece", F.concat_ws(":", "s", "e"))
    return intervals.multiplicity(f.where("source = 'R'"), pieces.select(*SK, "s", "e", "piece"), SK, "id", "piece").select("id", "kind")


@query(*_after("feat", "ev AS (SELECT * FROM feat WHERE source <> 'R'), " + _pieces("ev", "seqid, strand", 5), """
    SELECT p.seqid, p.strand, p.s::BIGINT AS s, p.e::BIGINT AS e, p.n, count(f.id) AS joined FROM pieces p
    LEFT JOIN feat f ON f.source = 'R' AND f.seqid = p.seqid AND f.strand = p.strand AND f.s <= p.e AND p.s <= f.e GROUP BY ALL"""))
def merge_into_cluster(spark, d):
    f = A.feat(spark, d)
    pieces = intervals.merge(f.where("source <> 'R'"), SK, 5)
    met = intervals.overlap_join(pieces, _b(f.where("source = 'R'"), "id"), SK).groupBy(*SK, "s", "e").agg(F.count("*").alias("joined"))
    return pieces.join(met, [*SK, "s", "e"], "left").select(*SK, "s", "e", "n", F.coalesce("joined", F.lit(0)).alias("joined"))


_ISLANDS = _pieces("feat", "seqid, strand", 15)


@query(*_after("feat", _ISLANDS, """
    SELECT id, island::BIGINT AS cluster, rank FROM (SELECT id, island, row_number() OVER (PARTITION BY seqid, strand, island ORDER BY source DESC, e - s DESC, score DESC, id) AS rank FROM _i) WHERE rank <= 2"""))
def shadow_cluster_topk(spark, d):
    order = [F.desc("source"), F.desc(F.col("e") - F.col("s")), F.desc("score"), F.col("id")]
    return clusters.shadow_clusters(A.feat(spark, d), SK, order, 2, 15).select("id", "cluster", "rank")


@query(*_after("feat", _ISLANDS, """
    SELECT id, source, rank FROM (SELECT id, source, row_number() OVER (PARTITION BY seqid, strand, island, source ORDER BY e - s DESC, score DESC, id) AS rank FROM _i) WHERE rank <= 1"""))
def shadow_cluster_per_source(spark, d):
    order = [F.desc(F.col("e") - F.col("s")), F.desc("score"), F.col("id")]
    return clusters.shadow_clusters(A.feat(spark, d), SK, order, 1, 15, ["source"]).select("id", "source", "rank")


@query(*_after("feat hsps hits", _pieces("hits", "seqid, strand").replace("> p + 1", "> p"), "SELECT seqid, strand, min(hit) AS component, count(*) AS hits, min(s) AS s, max(e) AS e FROM _i GROUP BY seqid, strand, island"))
def span_components(spark, d):
    """Components of hits whose spans overlap (touching isn't overlapping)."""
    labelled = intervals.islands(A.hits(spark, d), SK, name="_i", touch=0)
    return labelled.groupBy(*SK, "_i").agg(F.min("hit").alias("component"), F.count("*").alias("hits"), F.min("s").alias("s"), F.max("e").alias("e")).drop("_i")


@query("feat hsps", """, ed AS (SELECT DISTINCT a.seqid, a.strand, a.hit AS x, b.hit AS y FROM hsps a JOIN hsps b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e),
    reach AS (SELECT seqid, strand, x AS node, y AS other FROM ed UNION SELECT r.seqid, r.strand, r.node, ed.y FROM reach r JOIN ed ON ed.seqid = r.seqid AND ed.strand = r.strand AND ed.x = r.other)
    SELECT seqid, strand, node AS hit, min(other) AS component FROM reach GROUP BY seqid, strand, node""")
def hsp_components(spark, d):
    """C4: hits whose blocks overlap, transitively, solved inside components of whole spans."""
    h = A.hsps(spark, d)
    spans = intervals.islands(A.hits(spark, d).select("hit", *SK, "s", "e"), SK, name="part").select("hit", *SK, "part")
    rows = h.join(spans, ["hit", *SK])
    return clusters.components_in_groups(rows, [*SK, "part"], "hit").select(*SK, "hit", "component")


_EDGES = """, ed AS (SELECT DISTINCT a.seqid, a.strand, a.hit AS x, b.hit AS y FROM hits a JOIN hits b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e AND a.hit < b.hit),
    bo AS (SELECT * FROM ed UNION ALL SELECT seqid, strand, y, x FROM ed), dg AS (SELECT seqid, strand, x, count(*) AS d FROM bo GROUP BY ALL)
    SELECT seqid, strand, x, y, round(n / (dx + dy - n), 6) AS jaccard FROM (SELECT ed.*, d1.d AS dx, d2.d AS dy, 1 + (SELECT count(*) FROM bo p JOIN bo q ON p.y = q.y AND p.seqid = q.seqid AND p.strand = q.strand WHERE p.x = ed.x AND q.x = ed.y AND p.seqid = ed.seqid AND p.strand = ed.strand) AS n
      FROM ed JOIN dg d1 ON d1.seqid = ed.seqid AND d1.strand = ed.strand AND d1.x = ed.x JOIN dg d2 ON d2.seqid = ed.seqid AND d2.strand = ed.strand AND d2.x = ed.y) WHERE n / (dx + dy - n) >= 0.5"""


@query("feat hsps hits", _EDGES)
def jaccard_edges(spark, d):
    edges = clusters.overlap_edges(A.hits(spark, d), SK, "hit")
    return clusters.jaccard_edges(edges, SK, 0.5).withColumn("jaccard", F.round("jaccard", 6))


@query(*_after("feat", _pieces("feat", "seqid"), """,
    rk AS (SELECT id, seqid, island, s, e, row_number() OVER (PARTITION BY seqid, island ORDER BY score DESC, id) AS r FROM _i),
    go AS (SELECT seqid, island, 1 AS r, [struct_pack(id := id, s := s, e := e)] AS kept FROM rk WHERE r = 1
      UNION ALL SELECT go.seqid, go.island, rk.r::INT, CASE WHEN len(list_filter(kept, lambda k: k.s <= rk.e AND rk.s <= k.e)) = 0 THEN list_append(kept, struct_pack(id := rk.id, s := rk.s, e := rk.e)) ELSE kept END
      FROM go JOIN rk ON rk.seqid = go.seqid AND rk.island = go.island AND rk.r = go.r + 1),
    fin AS (SELECT seqid, unnest(kept) AS k FROM (SELECT *, max(r) OVER (PARTITION BY seqid, island) AS last FROM go) WHERE r = last)
    SELECT seqid, k.id AS id, k.s AS s, k.e AS e FROM fin"""))
def greedy_select(spark, d):
    return selection.greedy(A.feat(spark, d, parts=True), ["seqid"], [F.desc("score"), F.col("id")], "id", made=A.feat_id(), n=A.n_feat(spark, d))


@query("feat", f"""SELECT a, b, round(dist, 6) AS distance FROM (
    SELECT *, row_number() OVER (PARTITION BY a ORDER BY dist, b) AS l, row_number() OVER (PARTITION BY b ORDER BY dist, a) AS r FROM (
      SELECT a.id AS a, b.id AS b, 1 - ((least(a.e, b.e) - greatest(a.s, b.s) + 1) / (a.e - a.s + 1) + (least(a.e, b.e) - greatest(a.s, b.s) + 1) / (b.e - b.s + 1)) / 2 AS dist
      FROM feat a JOIN feat b ON {MEET} WHERE a.source = 'R' AND b.source = 'A') WHERE dist <= 0.5) WHERE l = 1 AND r = 1""")
def reciprocal_best(spark, d):
    f = A.feat(spark, d)
    pairs = intervals.overlap_join(f.where("source = 'R'").select("id", *SK, "s", "e"), _b(f.where("source = 'A'"), "id"), SK)
    shared = F.least("e", "be") - F.greatest("s", "bs") + 1
    dist = 1 - (shared / (F.col("e") - F.col("s") + 1) + shared / (F.col("be") - F.col("bs") + 1)) / 2
    best = selection.reciprocal_best(pairs.select(F.col("id").alias("a"), F.col("b_id").alias("b"), dist.alias("distance")), "a", "b", "distance", 0.5)
    return best.withColumn("distance", F.round("distance", 6))


@query("feat", """, w AS (SELECT seqid, min(s) AS lo, max(e) AS hi FROM feat WHERE source = 'R' AND s BETWEEN 1500 AND 2000 GROUP BY seqid)
    SELECT f.seqid, count(*) AS rows, min(f.s) AS s, max(f.e) AS e FROM feat f JOIN w USING (seqid) WHERE f.source <> 'R' AND f.s BETWEEN w.lo AND w.hi GROUP BY f.seqid""")
def window_scan(spark, d):
    """Parents that start in a window, then children that start within the parents' widened window."""
    f = A.feat(spark, d)
    window = f.where("source = 'R' and s between 1500 and 2000").groupBy("seqid").agg(F.min("s").alias("lo"), F.max("e").alias("hi"))
    met = f.where("source <> 'R'").join(window, "seqid").where("s between lo and hi")
    return met.groupBy("seqid").agg(F.count("*").alias("rows"), F.min("s").alias("s"), F.max("e").alias("e"))


@query("seqs", """, l AS (SELECT seqid, length(seq) AS length, greatest(1, length(seq) // 400 + CASE WHEN length(seq) % 400 * 2 >= 400 THEN 1 ELSE 0 END) AS n FROM seqs WHERE length(seq) > 0),
    c AS (SELECT *, unnest(range(0, n)) AS k FROM l)
    SELECT seqid, k::INT AS number, k * 400 + 1 AS s, CASE WHEN k = n - 1 THEN length ELSE (k + 1) * 400 END AS e, greatest(1, k * 400 + 1 - 50) AS ws, least(length, CASE WHEN k = n - 1 THEN length ELSE (k + 1) * 400 END + 50) AS we, k = 0 AS is_first, k = n - 1 AS is_last FROM c""")
def chunks(spark, d):
    lengths = A.seqs(spark, d).select("seqid", F.length("seq").cast("long").alias("length"))
    return intervals.chunks(lengths, 400, 50)


@query(*_after("feat", _ISLANDS, "SELECT seqid, strand, island::BIGINT AS cluster, max_by(id, struct_pack(n := e - s, id := id)) AS longest, min(s) AS s, max(e) AS e FROM _i GROUP BY seqid, strand, island"))
def collapse_longest(spark, d):
    """P20: each cluster's span with its longest member's identity."""
    labelled = intervals.islands(A.feat(spark, d), SK, 15, "cluster", rows=A.n_feat(spark, d))
    return labelled.groupBy(*SK, "cluster").agg(F.max_by("id", F.struct(F.col("e") - F.col("s"), F.col("id"))).alias("longest"), F.min("s").alias("s"), F.max("e").alias("e"))
