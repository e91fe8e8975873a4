"""Queries on hits: transforms, filters, orders and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.operators import hits, intervals
from locusframe.plans.interval_queries import SK, _after, _pieces
from locusframe.plans.registry import query, table
from locusframe.sources import adapters as A

HK = ["hit", "strand"]


@query("feat hsps", "SELECT hit, strand, string_agg(s || '-' || e, ',' ORDER BY s, e) AS coordinates FROM hsps GROUP BY hit, strand")
def hsp_coordinates(spark, d):
    """P2"""
    return hits.coordinates(A.hsps(spark, d), HK)


@query("feat hsps", "SELECT hit || '.' || row_number() OVER (PARTITION BY hit, strand ORDER BY s, e, id) AS name, seqid, strand, s, e FROM hsps")
def shatter_hits(spark, d):
    """P4"""
    rows = hits.shattered(A.hsps(spark, d), HK, ["s", "e", "id"])
    return rows.select(F.concat_ws(".", "hit", "part").alias("name"), *SK, "s", "e")


@query("feat hsps", "SELECT id, s + 1000 * (seqid % 7) AS s, e + 1000 * (seqid % 7) AS e FROM hsps")
def shift_offset(spark, d):
    """Blocks moved by their chunk's offset."""
    offset = 1000 * (F.col("seqid") % 7)
    return A.hsps(spark, d).select("id", (F.col("s") + offset).alias("s"), (F.col("e") + offset).alias("e"))


_CHAINS = """, bf AS (SELECT *, max(e) OVER (PARTITION BY hit, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM hsps),
    ch AS (SELECT *, sum(CASE WHEN s - p > {most} THEN 1 ELSE 0 END) OVER (PARTITION BY hit, strand ORDER BY s, e, p NULLS FIRST ROWS UNBOUNDED PRECEDING)::BIGINT AS chain FROM bf)"""


@query("feat hsps", _CHAINS.format(most=120) + " SELECT hit, strand, chain, min(s) AS s, max(e) AS e, count(*) AS blocks FROM ch GROUP BY ALL")
def merge_same_name(spark, d):
    """P12"""
    return hits.joined_by_name(A.hsps(spark, d), HK, 120, rows=A.n_feat(spark, d)).groupBy(*HK, "chain").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("blocks"))


@query("feat hsps", _CHAINS.format(most=40) + """, gr AS (SELECT hit, strand, chain, min(s) AS s, max(e) AS e, min((s - 1) // 500) AS low, max((e - 1) // 500) AS high FROM ch GROUP BY ALL)
    SELECT hit, strand, s, e, high - low AS breaks FROM gr WHERE high > low""")
def junction_merge(spark, d):
    """Hits of one name that meet across the ends of chunks of 500, within 40."""
    chains = hits.joined_by_name(A.hsps(spark, d), HK, 40, rows=A.n_feat(spark, d)).groupBy(*HK, "chain").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    breaks = F.expr("(e - 1) div 500 - (s - 1) div 500")
    return chains.withColumn("breaks", breaks).where("breaks > 0").select(*HK, "s", "e", "breaks")


@query("feat hsps", "SELECT hit, round(sum((e - s + 1) - id_gap) / sum(e - s + 1), 3) AS identity FROM (SELECT *, least(e - s + 1, round(score * 100)::BIGINT % 7) AS id_gap FROM hsps) GROUP BY hit")
def hit_identity(spark, d):
    """Here a block's differences are its score in cents modulo 7."""
    gap = F.least(hits.length(), F.round(F.col("score") * 100).cast("long") % 7)
    return hits.identity(A.hsps(spark, d).withColumn("same", hits.length() - gap), ["hit"], "same")


@query("feat hsps", "SELECT hit, CASE WHEN count_if(strand < 0) * 2 > count(*) THEN -1 ELSE 1 END AS strand, count(*) AS n FROM hsps GROUP BY hit")
def majority_strand(spark, d):
    """Z3"""
    return hits.majority_strand(A.hsps(spark, d), ["hit"])


@query("feat hsps", "SELECT hit, strand, CASE WHEN strand < 0 THEN max(e) ELSE min(s) END AS begin, CASE WHEN strand < 0 THEN min(s) ELSE max(e) END AS \"end\" FROM hsps GROUP BY hit, strand")
def natural_ends(spark, d):
    """Z2"""
    return hits.natural_ends(A.hsps(spark, d), HK)


@query("feat hsps", """, gr AS (SELECT hit, seqid, CASE WHEN count(DISTINCT strand) > 1 THEN 'x' WHEN min(strand) < 0 THEN '-' ELSE '+' END AS side FROM hsps GROUP BY hit, seqid)
    SELECT h.id, side, CASE WHEN side = '-' THEN e ELSE s END AS begin, CASE WHEN side = '-' THEN s ELSE e END AS "end" FROM hsps h JOIN gr USING (hit, seqid)""")
def strand_rows(spark, d):
    """Every block with its hit's side (plus, minus or mixed), ends flipped on the minus side."""
    h = A.hsps(spark, d)
    low, high = F.min("strand"), F.max("strand")
    side = h.groupBy("hit", "seqid").agg(F.when(low != high, "x").when(low < 0, "-").otherwise("+").alias("side"))
    minus = F.col("side") == "-"
    return h.join(side, ["hit", "seqid"]).select("id", "side", F.when(minus, F.col("e")).otherwise(F.col("s")).alias("begin"), F.when(minus, F.col("s")).otherwise(F.col("e")).alias("end"))


@query(*_after("feat hsps", _pieces("hsps", "hit"), ", b AS (SELECT hit, sum(e - s + 1) AS n FROM pieces GROUP BY hit), l AS (SELECT hit, max(e) AS length FROM hsps GROUP BY hit) SELECT hit, round(n / length, 4) AS share FROM b JOIN l USING (hit)"))
def aligned_share(spark, d):
    """A8"""
    h = A.hsps(spark, d)
    return hits.aligned_share(h, ["hit"], h.groupBy("hit").agg(F.max("e").alias("length")))


@query("feat hsps", "SELECT hit, strand, round(sum(score), 2) AS score FROM hsps GROUP BY hit, strand")
def hit_total_score(spark, d):
    """A9"""
    return A.hsps(spark, d).groupBy(*HK).agg(F.round(F.sum("score"), 2).alias("score"))


@query("feat hsps", "SELECT hit, strand, count(*) AS blocks, min(s) AS s, max(e) AS e FROM hsps WHERE score > 20000 GROUP BY hit, strand")
def score_floor(spark, d):
    """hits of the blocks over a score."""
    return A.hsps(spark, d).where("score > 20000").groupBy(*HK).agg(F.count("*").alias("blocks"), F.min("s").alias("s"), F.max("e").alias("e"))


@query("feat hsps", "SELECT hit, strand, count(*) AS blocks, round(sum(score), 2) AS total FROM hsps WHERE score > 5000 GROUP BY hit, strand HAVING sum(score) > 60000")
def prediction_filter(spark, d):
    """Blocks over a score, then hits over a total."""
    return A.hsps(spark, d).where("score > 5000").groupBy(*HK).agg(F.count("*").alias("blocks"), F.sum("score").alias("t")).where("t > 60000").select(*HK, "blocks", F.round("t", 2).alias("total"))


@query("feat hsps", """SELECT hit, strand, bool_and(a = b) AS contiguous FROM (SELECT hit, strand, row_number() OVER (PARTITION BY hit, strand ORDER BY s, e, id) AS a, row_number() OVER (PARTITION BY hit, strand ORDER BY score, id) AS b FROM hsps) GROUP BY hit, strand""")
def contiguous_hits(spark, d):
    """the blocks' scores stand for positions on the hit's own side."""
    return hits.contiguous(A.hsps(spark, d), HK, ["score", "id"])


@query("feat hsps", "SELECT hit, strand, string_agg(id, ',' ORDER BY score DESC, id) AS ids FROM hsps GROUP BY hit, strand")
def hsps_by_score(spark, d):
    """W10"""
    row = F.struct((-F.col("score")).alias("k"), "id")
    return A.hsps(spark, d).groupBy(*HK).agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["id"]), ",").alias("ids"))


@query("feat hsps hits", "SELECT seqid, strand, hit, row_number() OVER (PARTITION BY seqid, strand ORDER BY n DESC, e - s DESC, hit) AS place FROM hits")
def alt_splice_order(spark, d):
    """Most blocks first, then the longest."""
    w = Window.partitionBy(*SK).orderBy(F.desc("n"), F.desc(F.col("e") - F.col("s")), "hit")
    return A.hits(spark, d).select(*SK, "hit", F.row_number().over(w).alias("place"))


@query("feat hsps hits", """, pt AS (SELECT hit, strand, s AS ps, e AS pe FROM hsps WHERE source = 'R')
    SELECT hit, strand, coalesce(ps, s) AS s, coalesce(pe, e) AS e FROM hits LEFT JOIN pt USING (hit, strand)""")
def parts_or_self(spark, d):
    """Hits with their returned blocks, or themselves."""
    parts = A.hsps(spark, d).where("source = 'R'").select(F.struct(*HK).alias("key"), F.col("s").alias("ps"), F.col("e").alias("pe"))
    bases = A.hits(spark, d).select(F.struct(*HK).alias("key"), "s", "e")
    return hits.parts_or_self(bases, parts, "key").select("key.hit", "key.strand", F.col("ps").alias("s"), F.col("pe").alias("e"))


@query("feat", "SELECT CASE WHEN sup % 3 = 0 THEN 'h' || id ELSE 'g' || okey END AS cluster, count(*) AS n, min(s) AS s, max(e) AS e FROM feat GROUP BY 1")
def gene_id_or_own(spark, d):
    """Rows of every third supplier have no gene id."""
    rows = hits.gene_id_or_own(A.feat(spark, d), F.when(F.col("sup") % 3 != 0, F.col("okey")), F.col("id"))
    return rows.groupBy("cluster").agg(F.count("*").alias("n"), F.min("s").alias("s"), F.max("e").alias("e"))


@query(*_after("feat hsps", "sh AS (SELECT seqid, id, s, e FROM hsps WHERE source <> 'N'), " + _pieces("sh", "seqid", 20), "SELECT seqid, min(s)::BIGINT AS s, max(e)::BIGINT AS e, max_by(id, struct_pack(n := e - s, id := id)) AS longest FROM _i GROUP BY seqid, island"))
def te_clusters(spark, d):
    """Single blocks, clustered with flank 20 whatever their strand, as spans named after the longest."""
    labelled = intervals.islands(A.hsps(spark, d).where("source <> 'N'").select("seqid", "id", "s", "e"), ["seqid"], 20, "cluster")
    return labelled.groupBy("seqid", "cluster").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.max_by("id", F.struct(F.col("e") - F.col("s"), F.col("id"))).alias("longest")).drop("cluster")


@query("feat", "SELECT priority, source, count(*) AS n, sum(e - s + 1)::BIGINT AS bases FROM (SELECT 1 AS priority, * FROM feat WHERE source = 'R' UNION ALL SELECT 2, * FROM feat WHERE source = 'A' UNION ALL SELECT 3, * FROM feat WHERE strand = 1) GROUP BY priority, source")
def combined_lists(spark, d):
    """Lists one after the other, each with its place."""
    f = A.feat(spark, d)
    lists = [f.where("source = 'R'"), f.where("source = 'A'"), f.where("strand = 1")]
    both = None
    for i, x in enumerate(lists, 1):
        x = x.withColumn("priority", F.lit(i))
        both = x if both is None else both.unionByName(x)
    return both.groupBy("priority", "source").agg(F.count("*").alias("n"), F.sum(hits.length()).alias("bases"))


@query("feat hsps", "SELECT DISTINCT seqid, strand, s, e, source FROM hsps")
def evidence_union(spark, d):
    """Distinct evidence."""
    return A.hsps(spark, d).select(*SK, "s", "e", "source").distinct()


@query("feat", "SELECT seqid FROM feat WHERE source = 'R' AND s > 1000 INTERSECT SELECT seqid FROM feat WHERE source = 'A' AND s > 1000 EXCEPT SELECT seqid FROM feat WHERE source = 'N' AND s BETWEEN 1400 AND 1500")
def shared_contigs(spark, d):
    """U6"""
    f = A.feat(spark, d).select("seqid", "source", "s")
    of = lambda c: f.where(c).select("seqid")
    return of("source = 'R' and s > 1000").intersect(of("source = 'A' and s > 1000")).exceptAll(of("source = 'N' and s between 1400 and 1500").distinct().join(of("source = 'R' and s > 1000").distinct(), "seqid", "left_semi")).distinct()


@query("feat hsps", "SELECT hit, strand, count_if(1500 BETWEEN s AND e) AS holds, bool_or(1500 BETWEEN s AND e) AS held FROM hsps GROUP BY hit, strand")
def position_contained(spark, d):
    """Blocks that hold a position."""
    inside = F.lit(1500).between(F.col("s"), F.col("e"))
    return A.hsps(spark, d).groupBy(*HK).agg(F.count_if(inside).alias("holds"), F.bool_or(inside).alias("held"))


_OPS = "translate(seq, 'ACGT', 'MMID')"


@query("seqs", f"SELECT seqid, array_to_string(list_transform(regexp_extract_all({_OPS}, 'M+|I+|D+'), lambda r: r[1] || length(r)), '') AS cigar FROM seqs WHERE length(seq) > 0")
def cigar_runs(spark, d):
    """Letters read as operations."""
    return A.seqs(spark, d).where("length(seq) > 0").select("seqid", hits.operations(F.translate("seq", "ACGT", "MMID")).alias("cigar"))


@query("seqs", "SELECT seqid, regexp_matches(substr(seq, 11, 200), '[AC]{6}') AS has_run FROM seqs")
def match_runs(spark, d):
    """Whether a region holds a run of at least six match symbols (here A and C)."""
    return A.seqs(spark, d).select("seqid", F.substring("seq", 11, 200).rlike("[AC]{6}").alias("has_run"))


@query("feat", "SELECT id, s - 1 AS zero_s, e AS zero_e, (s - 1) // 3 AS codon FROM feat")
def space_base(spark, d):
    """1-based closed to 0-based half open."""
    return A.feat(spark, d).select("id", (F.col("s") - 1).alias("zero_s"), F.col("e").alias("zero_e"), F.expr("(s - 1) div 3").alias("codon"))


_TX = """, tx AS (SELECT *, sum(e - s + 1) OVER w - (e - s + 1) AS start_in, sum(e - s + 1) OVER w AS upto, row_number() OVER w AS number, lead(id) OVER w AS nx, lead(s) OVER w AS ns, lead(e) OVER w AS ne
      FROM hsps WINDOW w AS (PARTITION BY hit, strand ORDER BY s * strand, e * strand, id ROWS UNBOUNDED PRECEDING))"""
_TX = _TX.replace("lead(id) OVER w", "lead(id) OVER v").replace("lead(s) OVER w", "lead(s) OVER v").replace("lead(e) OVER w", "lead(e) OVER v").replace("ROWS UNBOUNDED PRECEDING))", "ROWS UNBOUNDED PRECEDING), v AS (PARTITION BY hit, strand ORDER BY s * strand, e * strand, id))")


@query("feat hsps", _TX + " SELECT id, number, start_in::BIGINT AS start_in, CASE WHEN nx IS NOT NULL THEN upto END::BIGINT AS junction FROM tx")
def splice_junctions(spark, d):
    """Z16"""
    return hits.exons_in_transcript(A.hsps(spark, d), HK).select("id", "number", "start_in", "junction")


@query("feat hsps", _TX + " SELECT hit, strand, number, id AS left_id, nx AS right_id FROM tx WHERE nx IS NOT NULL")
def exon_pairs(spark, d):
    """Consecutive exons in the strand's direction."""
    order = Window.partitionBy(*HK).orderBy(F.col("s") * F.col("strand"), F.col("e") * F.col("strand"), "id")
    rows = A.hsps(spark, d).select(*HK, F.row_number().over(order).alias("number"), F.col("id").alias("left_id"), F.lead("id").over(order).alias("right_id"))
    return rows.where("right_id is not null")


@query("feat hsps hits", _TX + """, cb AS (SELECT hit, strand, CASE WHEN strand > 0 THEN s + 30 ELSE e - 30 END AS p FROM hits)
    SELECT hit, strand, min_by(id, number) AS exon, min(number) AS number, min_by(start_in + CASE WHEN strand > 0 THEN p - s ELSE e - p END, number)::BIGINT AS position FROM tx JOIN cb USING (hit, strand) WHERE p BETWEEN s AND e GROUP BY hit, strand""")
def first_coding_exon(spark, d):
    """The exon that holds the translation's begin (here 30 behind the hit's), and that begin in transcript space."""
    begin = A.hits(spark, d).select(*HK, F.when(F.col("strand") > 0, F.col("s") + 30).otherwise(F.col("e") - 30).alias("p"))
    rows = hits.exons_in_transcript(A.hsps(spark, d), HK).join(begin, HK).where("p between s and e")
    at = F.col("start_in") + F.when(F.col("strand") > 0, F.col("p") - F.col("s")).otherwise(F.col("e") - F.col("p"))
    return rows.groupBy(*HK).agg(F.min_by("id", "number").alias("exon"), F.min("number").alias("number"), F.min_by(at, "number").alias("position"))


@query(*_after("feat", "ev AS (SELECT * FROM feat WHERE source = 'R'), " + _pieces("ev", "seqid"), """, l AS (SELECT seqid, max(e) AS length FROM feat GROUP BY seqid), x AS (SELECT seqid, list(struct_pack(s := s, e := e) ORDER BY s) AS p FROM pieces GROUP BY seqid)
    SELECT seqid, md5(array_to_string(list_transform(range(1, length + 1), lambda b: CASE WHEN len(list_filter(coalesce(p, []), lambda q: q.s <= b AND b <= q.e)) > 0 THEN '1' ELSE '0' END), '')) AS covered FROM l LEFT JOIN x USING (seqid)"""))
def coverage_text(spark, d):
    """A28"""
    f = A.feat(spark, d)
    pieces = intervals.merge(f.where("source = 'R'"), ["seqid"])
    return hits.coverage_text(pieces, f.groupBy("seqid").agg(F.max("e").alias("length")), "seqid").select("seqid", F.md5("covered").alias("covered"))


@query("", "SELECT s_name AS name, 'server' AS origin FROM supplier UNION ALL SELECT c_name, 'user' FROM customer WHERE c_custkey % 10 = 0")
def menu_union(spark, d):
    """Rows of the server, then those of users."""
    server = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.lit("server").alias("origin"))
    return server.unionByName(table(spark, d, "customer").where("c_custkey % 10 = 0").select(F.col("c_name").alias("name"), F.lit("user").alias("origin")))
