"""Queries on hits and feature lines: filters, splits, rewrites, and GFF3 text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.operators import clusters, intervals
from locusframe.plans.interval_queries import SK, _after, _pieces
from locusframe.plans.registry import query, table
from locusframe.sources import adapters as A
from locusframe.sources import gff3


@query("", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_discount <= 0.05 AND l_quantity >= 20 / 2 AND greatest(l_tax, l_discount) >= 0.03")
def keep_filter(spark, d):
    """significance, half the wanted coverage, the better of two identities; pushed to the scan where it can be."""
    rows = table(spark, d, "lineitem").where((F.col("l_discount") <= 0.05) & (F.col("l_quantity") >= 10) & (F.greatest("l_tax", "l_discount") >= 0.03))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("feat hsps", "SELECT hit, count(*) AS parts, count_if(strand = 1) AS plus, count_if(strand = -1) AS minus, CASE WHEN sum(strand) >= 0 THEN 1 ELSE -1 END AS majority FROM hsps GROUP BY hit")
def strand_split(spark, d):
    """A hit's blocks by strand, and the majority (ties are plus)."""
    return A.hsps(spark, d).groupBy("hit").agg(F.count("*").alias("parts"), F.count_if(F.col("strand") == 1).alias("plus"), F.count_if(F.col("strand") == -1).alias("minus"), F.when(F.sum("strand") >= 0, 1).otherwise(-1).alias("majority"))


@query(*_after("feat hsps", _pieces("hsps", "hit, strand"), "SELECT hit, strand, s::BIGINT AS s, e::BIGINT AS e, n FROM pieces"))
def normalize_exons(spark, d):
    """Overlapping blocks of a hit as merged pieces."""
    return intervals.merge(A.hsps(spark, d), ["hit", "strand"], rows=A.n_feat(spark, d))


@query("feat hsps hits", """SELECT p.hit, p.strand, p.id, greatest(p.s, h.s + 100) AS s, least(p.e, h.e - 100) AS e FROM hsps p JOIN hits h ON p.hit = h.hit AND p.strand = h.strand
    WHERE greatest(p.s, h.s + 100) <= least(p.e, h.e - 100)""")
def clip_utr(spark, d):
    """P10: blocks clipped to the coding span, here the hit's span less 100 at each end."""
    h = A.hsps(spark, d)
    w = Window.partitionBy("hit", "strand")
    rows = h.withColumn("hs", F.min("s").over(w) + 100).withColumn("he", F.max("e").over(w) - 100)
    return rows.select("hit", "strand", "id", F.greatest("s", "hs").alias("s"), F.least("e", "he").alias("e")).where("s <= e")


@query("feat hsps", "SELECT hit, strand, string_agg(concat(s, '-', e), ',' ORDER BY CASE WHEN strand = 1 THEN s ELSE -e END, e, id) AS blocks FROM hsps GROUP BY hit, strand")
def sorted_blocks(spark, d):
    """Blocks in the strand's direction."""
    row = F.struct(F.when(F.col("strand") == 1, F.col("s")).otherwise(-F.col("e")).alias("k"), "e", "id", "s")
    blocks = F.transform(F.array_sort(F.collect_list(row)), lambda x: F.concat_ws("-", x["s"], x["e"]))
    return A.hsps(spark, d).groupBy("hit", "strand").agg(F.array_join(blocks, ",").alias("blocks"))


@query("feat", "SELECT evidence, count(*) AS n, min(s) AS s, max(e) AS e FROM (SELECT *, CASE source WHEN 'R' THEN 'est' WHEN 'A' THEN 'protein' ELSE 'pred' END AS evidence FROM feat) GROUP BY evidence")
def route_evidence(spark, d):
    """Rows routed to evidence types by their source's name."""
    name = F.when(F.col("source") == "R", "est2genome").when(F.col("source") == "A", "blastx").otherwise("snap")
    rows = A.feat(spark, d).withColumn("source", name).withColumn("type", F.lit("match"))
    return gff3.routed(rows).groupBy(F.col("evidence_type").alias("evidence")).agg(F.count("*").alias("n"), F.min("s").alias("s"), F.max("e").alias("e"))


@query("feat", "SELECT id, seqid::VARCHAR AS seqid, s, e, strand, sup::VARCHAR AS parent FROM feat")
def gff3_round_trip(spark, d):
    """Features as GFF3 text, and the text read as features."""
    f = A.feat(spark, d)
    bag = F.create_map(F.lit("ID"), F.array("id"), F.lit("Parent"), F.array(F.col("sup").cast("string")))
    rows = f.select(F.col("seqid").cast("string").alias("seqid"), "source", F.lit("match").alias("type"), "s", "e", "score", "strand", F.lit(None).cast("int").alias("phase"), bag.alias("attributes"))
    back = gff3.by_parent(gff3.features(gff3.lines(rows)))
    return back.select(F.expr("attributes['ID'][0]").alias("id"), "seqid", "s", "e", "strand", "parent")


@query("feat", """SELECT seqid, source, class, count(*) AS n FROM (SELECT *, CASE source WHEN 'R' THEN 4 WHEN 'A' THEN 3 ELSE 1 END AS class FROM feat) GROUP BY ALL""")
def evidence_classes(spark, d):
    """How far each row's algorithm is trusted."""
    name = F.when(F.col("source") == "R", "est2genome").when(F.col("source") == "A", "blastx").otherwise("snap")
    return A.feat(spark, d).withColumn("class", clusters.evidence_class(name, "final")).groupBy("seqid", "source", "class").agg(F.count("*").alias("n"))


@query("feat", """SELECT id, CASE WHEN 100 <= s AND e <= 3000 THEN 'kept' WHEN s > 3000 OR e < 100 THEN 'out' ELSE 'held' END AS state FROM feat""")
def chunk_divide(spark, d):
    """Rows that lie in a chunk are kept, those over its edge held."""
    state = F.when((F.col("s") >= 100) & (F.col("e") <= 3000), "kept").when((F.col("s") > 3000) | (F.col("e") < 100), "out").otherwise("held")
    return A.feat(spark, d).select("id", state.alias("state"))


@query("feat hsps", """, si AS (SELECT DISTINCT seqid, strand, e AS site FROM hsps WHERE hit % 5 = 0), rd AS (SELECT seqid, strand, s, e FROM hsps WHERE hit % 5 <> 0)
    SELECT si.seqid, si.strand, site, count(rd.s) AS reads FROM si LEFT JOIN rd ON rd.seqid = si.seqid AND rd.strand = si.strand AND rd.s + 5 <= site AND site + 4 <= rd.e GROUP BY ALL""")
def position_support(spark, d):
    """How many reads (rows of other hits) reach five bases past a splice site (a model's exon end) on both sides."""
    h = A.hsps(spark, d)
    sites = h.where("hit % 5 = 0").select(*SK, F.col("e").alias("site")).distinct()
    points = sites.select(*SK, (F.col("site")).alias("s"), (F.col("site") + 4).alias("e"), "site")
    reads = h.where("hit % 5 <> 0").select(*SK, "s", "e")
    met = intervals.overlap_join(points, reads, SK).where("bs + 5 <= site and site + 4 <= be").groupBy(*SK, "site").agg(F.count("*").alias("reads"))
    return sites.join(met, [*SK, "site"], "left").select(*SK, "site", F.coalesce("reads", F.lit(0)).alias("reads"))


@query("", """SELECT role, count(*) AS n, count(DISTINCT conv_id) AS convs, sum(length(text))::BIGINT AS letters FROM conversations GROUP BY role
    UNION ALL SELECT NULL, count(*), count(DISTINCT conv_id), sum(length(text))::BIGINT FROM conversations""")
def grouping_sets(spark, d):
    """Totals beside groups, from one grouping."""
    c = table(spark, d, "conversations").select("role", "conv_id", F.length("text").cast("long").alias("k"))
    return c.rollup("role").agg(F.count("*").alias("n"), F.countDistinct("conv_id").alias("convs"), F.sum("k").alias("letters"))
