"""Queries that map ids, annotate, filter, number and walk hierarchies, and those on the job queue."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.operators import graphs, ranks, selection
from locusframe.plans.registry import query, table
from locusframe.sources import adapters as A
from locusframe.streaming import events


def _numbered_parts(spark, d):
    """Ids by size, then key."""
    p = ranks.numbered(table(spark, d, "part").select("p_partkey", "p_size"), [F.desc("p_size"), F.col("p_partkey")], "n")
    return p.select(F.col("p_partkey").alias("old_id"), F.concat(F.lit("P"), F.lpad(F.col("n").cast("string"), 8, "0")).alias("new_id"))


@query("idmap", "SELECT old_id, new_id FROM idmap")
def number_ids(spark, d):
    return _numbered_parts(spark, d)


@query("idmap", "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, coalesce(new_id, l_partkey::VARCHAR) AS feature FROM lineitem LEFT JOIN idmap ON l_partkey = old_id AND old_id % 3 <> 0")
def id_map(spark, d):
    """Ids swapped where the map has them, kept elsewhere."""
    ids = _numbered_parts(spark, d).where("old_id % 3 <> 0")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return rows.join(ids, F.col("l_partkey") == F.col("old_id"), "left").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.coalesce("new_id", F.col("l_partkey").cast("string")).alias("feature"))


@query("", "SELECT o_custkey, o_orderkey AS best, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def first_hit_annotation(spark, d):
    """The first hit of each query; an aggregate of structs, so map tasks keep one row per key."""
    first = F.min(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("m")
    return table(spark, d, "orders").groupBy("o_custkey").agg(first).select("o_custkey", F.col("m.o_orderkey").alias("best"), F.col("m.o_orderpriority").alias("o_orderpriority"))


@query("", "SELECT c_custkey, coalesce(string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority), '') AS xrefs FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def xrefs(spark, d):
    """Distinct cross references, sorted and joined."""
    refs = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("xrefs"))
    return table(spark, d, "customer").join(refs, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("xrefs", F.lit("")).alias("xrefs"))


@query("", """SELECT c_custkey, count(DISTINCT o_orderkey) AS transcripts, count(l_orderkey) AS exons, round(coalesce(sum(l_quantity), 0), 2) AS length
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_custkey""")
def parent_children(spark, d):
    """Gene to transcript to exon by parent id, each level counted before the next join."""
    exons = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey").join(exons, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    per = rows.groupBy("o_custkey").agg(F.count("*").alias("t"), F.sum("n").alias("e"), F.sum("q").alias("q"))
    both = table(spark, d, "customer").select("c_custkey").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return both.select("c_custkey", F.coalesce("t", F.lit(0)).alias("transcripts"), F.coalesce("e", F.lit(0)).alias("exons"), F.round(F.coalesce("q", F.lit(0.0)), 2).alias("length"))


@query("feat hsps", """, c AS (SELECT hit, strand, id, s, e, coalesce(sum(e - s + 1) OVER w, 0) AS t0 FROM hsps WINDOW w AS (PARTITION BY hit, strand ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    l AS (SELECT hit, strand, sum(e - s + 1) AS n FROM hsps GROUP BY hit, strand),
    p AS (SELECT c.hit, c.strand, c.id, s + greatest(n // 4 - t0, 0) AS gs, s + least(n // 2 - t0, e - s + 1) - 1 AS ge, t0, n, e - s + 1 AS len FROM c JOIN l ON c.hit = l.hit AND c.strand = l.strand)
    SELECT hit, strand, id, gs::BIGINT AS gs, ge::BIGINT AS ge FROM p WHERE t0 + len > n // 4 AND t0 < n // 2 AND gs <= ge""")
def project_domains(spark, d):
    """The second quarter of each transcript, lifted to the genome block by block."""
    h = A.hsps(spark, d)
    w = Window.partitionBy("hit", "strand").orderBy("s", "e", "id").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("e") - F.col("s") + 1
    whole = Window.partitionBy("hit", "strand")
    rows = h.withColumn("t0", F.coalesce(F.sum(size).over(w), F.lit(0))).withColumn("n", F.sum(size).over(whole)).withColumn("q1", F.expr("n div 4")).withColumn("q2", F.expr("n div 2"))
    lifted = rows.where((F.col("t0") + size > F.col("q1")) & (F.col("t0") < F.col("q2")))
    out = lifted.select("hit", "strand", "id", (F.col("s") + F.greatest(F.col("q1") - F.col("t0"), F.lit(0))).alias("gs"), (F.col("s") + F.least(F.col("q2") - F.col("t0"), size) - 1).alias("ge"))
    return out.where("gs <= ge")


@query("", "SELECT * FROM (SELECT doc_id, lang, n_chars FROM documents) d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def id_select(spark, d):
    keep = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(keep, "doc_id", "left_semi")


@query("", "SELECT * FROM (SELECT doc_id, lang, n_chars FROM documents) d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def id_remove(spark, d):
    gone = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(gone, "doc_id", "left_anti")


@query("", """, x AS (SELECT l_orderkey AS t, min(l_discount) AS aed, count_if(l_returnflag = 'R') AS pfam FROM lineitem GROUP BY l_orderkey)
    SELECT o_custkey, count(*) AS kept FROM orders JOIN x ON o_orderkey = t WHERE aed < 0.02 OR pfam > 2 GROUP BY o_custkey""".replace(", x AS", "WITH x AS", 1))
def quality_filter(spark, d):
    """transcripts kept by score or by domain, and the genes that keep any."""
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_discount").alias("aed"), F.count_if(F.col("l_returnflag") == "R").alias("pfam"))
    kept = x.where("aed < 0.02 or pfam > 2")
    return table(spark, d, "orders").join(kept, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.count("*").alias("kept"))


@query("", """WITH x AS (SELECT l_orderkey, count(*) AS n, sum(round(l_tax * 1000000)::BIGINT)::BIGINT AS t, count(l_tax) AS k, max(l_discount) AS a FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, n, (2 * t + 100 * k) // (200 * k) / 10000 AS splices, round(a, 4) AS aed FROM x WHERE t >= 30000 * k AND k > 0 AND a <= 0.08 AND n >= 2""")
def hc_filter(spark, d):
    """the mean is held against its threshold, and rounded half up to four digits, by a sum of whole millionths, which comes out the same in any order."""
    t = F.sum(F.round(F.col("l_tax") * 1_000_000).cast("long"))
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), t.alias("t"), F.count("l_tax").alias("k"), F.max("l_discount").alias("a"))
    return x.where("t >= 30000 * k and k > 0 and a <= 0.08 and n >= 2").select("l_orderkey", "n", F.expr("(2 * t + 100 * k) div (200 * k) / 10000").alias("splices"), F.round("a", 4).alias("aed"))


@query("feat", "SELECT okey, count(DISTINCT seqid) AS contigs, count(DISTINCT strand) = 1 AS one_strand, min(s) AS s, max(e) AS e FROM feat GROUP BY okey")
def gene_cluster(spark, d):
    """Rows by gene id, with the strand check."""
    return A.feat(spark, d).groupBy("okey").agg(F.countDistinct("seqid").alias("contigs"), (F.countDistinct("strand") == 1).alias("one_strand"), F.min("s").alias("s"), F.max("e").alias("e"))


@query("feat hsps", """, p AS (SELECT a.seqid, a.hit AS x, b.hit AS y, count(DISTINCT a.id) AS o, count(DISTINCT CASE WHEN a.s = b.s AND a.e = b.e THEN a.id END) AS same
      FROM hsps a JOIN hsps b ON a.seqid = b.seqid AND a.hit < b.hit AND a.s <= b.e AND b.s <= a.e GROUP BY ALL)
    SELECT seqid, x, y, concat(n - o, ':', o - same, ':', same) AS code FROM p JOIN (SELECT hit, count(*) AS n FROM hsps GROUP BY hit) t ON t.hit = x""")
def so_code(spark, d):
    """For pairs of isoforms, exons of the first that are alone, overlapped, identical."""
    from locusframe.operators import intervals

    h = A.hsps(spark, d).select("hit", "seqid", "id", "s", "e")
    pairs = intervals.overlap_join(h, h.select("seqid", "s", "e", F.col("hit").alias("y")), ["seqid"]).where("hit < y")
    same = F.col("s").eqNullSafe(F.col("bs")) & F.col("e").eqNullSafe(F.col("be"))
    per = pairs.groupBy("seqid", "hit", "y", "id").agg(F.max(same.cast("int")).alias("same")).groupBy("seqid", F.col("hit").alias("x"), "y").agg(F.count("*").alias("o"), F.sum("same").alias("same"))
    n = h.groupBy(F.col("hit").alias("x")).agg(F.count("*").alias("n"))
    return per.join(n, "x").select("seqid", "x", "y", F.concat_ws(":", F.col("n") - F.col("o"), F.col("o") - F.col("same"), "same").alias("code"))


@query("seqs", """SELECT seqid, CASE WHEN upper(substr(seq, 4, 3)) = 'ATG' THEN '1' ELSE '0' END || CASE WHEN upper(substr(seq, length(seq) - 2, 3)) IN ('TAG', 'TAA', 'TGA') THEN '1' ELSE '0' END AS completion FROM seqs WHERE length(seq) >= 6""")
def completion(spark, d):
    """Whether a start codon stands at the translation's begin (here the fourth base) and a stop codon at its end."""
    start = F.when(F.upper(F.substring("seq", 4, 3)) == "ATG", "1").otherwise("0")
    stop = F.when(F.upper(F.right("seq", F.lit(3))).isin("TAG", "TAA", "TGA"), "1").otherwise("0")
    return A.seqs(spark, d).where("length(seq) >= 6").select("seqid", F.concat(start, stop).alias("completion"))


#: Weights of the quality index's fields 2 to 6, alternative splicing, other evidence, and the bonus; by (coding, one exon).
WEIGHTS = {
    (True, True): (0, 50, 25, 0, 30, 30, 10, 60), (True, False): (100, 50, 25, 70, 30, 30, 10, 0),
    (False, True): (0, 50, 0, 0, 0, 30, 0, 120), (False, False): (100, 50, 0, 70, 0, 30, 0, 0),
}


def cvalue_of(qi, coding, so_first, so_last, alt, junk):
    """Qi is an array of the index's nine numbers. UTRs count 10 each, a disjoint isoform -50, an identical one 50."""
    value = None
    for (c, single), (*weights, of_alt, of_junk, bonus) in WEIGHTS.items():
        total = sum((qi[i + 1] * w for i, w in enumerate(weights)), F.lit(0.0)) + alt * of_alt + junk * of_junk + bonus
        test = (coding == F.lit(c)) & ((qi[6] == 1) == F.lit(single))
        value = F.when(test, total) if value is None else value.when(test, total)
    utrs = F.when(qi[0] != 0, 10).otherwise(0) + F.when(qi[7] != 0, 10).otherwise(0)
    return value + utrs + F.when(so_first != 0, -50).otherwise(0) + F.when(so_last != 0, 50).otherwise(0)


_CV = " ".join(f"WHEN (l_returnflag <> 'N') = {c} AND (l_linenumber = 1) = {one} THEN " + " + ".join(f"{x} * {w}" for x, w in zip(("l_discount", "l_tax", "l_discount * 2", "l_tax * 2", "l_discount * 3", "l_discount * 4", "l_tax * 4"), ws, strict=False)) + f" + {ws[-1]}" for (c, one), ws in WEIGHTS.items())


@query("feat", f"""SELECT id, round((CASE {_CV} END) + CASE WHEN l_suppkey % 3 <> 0 THEN 10 ELSE 0 END + CASE WHEN l_suppkey % 5 <> 0 THEN 10 ELSE 0 END + CASE WHEN l_partkey % 2 <> 0 THEN -50 ELSE 0 END + CASE WHEN l_partkey % 3 <> 0 THEN 50 ELSE 0 END, 4) AS score
    FROM (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT, round(l_extendedprice * 100)::BIGINT, date_diff('day', DATE '1992-01-01', l_shipdate::DATE)) AS id FROM lineitem)""")
def cvalue(spark, d):
    """The weighted score of every row, whose columns stand for the index's fields."""
    t = table(spark, d, "lineitem")
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date"))
    name = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long"), F.round(F.col("l_extendedprice") * 100).cast("long"), day)
    disc, tax = F.col("l_discount"), F.col("l_tax")
    qi = F.array(*[x.cast("double") for x in (F.col("l_suppkey") % 3, disc, tax, disc * 2, tax * 2, disc * 3, F.col("l_linenumber"), F.col("l_suppkey") % 5, F.lit(0))])
    score = cvalue_of(qi, F.col("l_returnflag") != "N", F.col("l_partkey") % 2, F.col("l_partkey") % 3, disc * 4, tax * 4)
    return t.select(name.alias("id"), F.round(score, 4).alias("score"))


_TRACE = """, walk AS (SELECT subject AS node, object AS ancestor, 1 AS depth FROM edges
    UNION ALL SELECT w.node, e.object, w.depth + 1 FROM walk w JOIN edges e ON w.ancestor = e.subject)"""


@query("edges", _TRACE + "SELECT node, ancestor, min(depth) AS depth FROM walk GROUP BY node, ancestor")
def ontology_trace(spark, d):
    return graphs.trace(A.edges(spark, d))


@query("edges", _TRACE + "SELECT node, max(depth) AS depth FROM walk GROUP BY node")
def ontology_depth(spark, d):
    return graphs.depths(A.edges(spark, d))


@query("edges", _TRACE + """, p AS (SELECT concat('c', c_custkey) AS a, concat('r', c_custkey % 5) AS b FROM customer)
    SELECT a, b, CASE WHEN EXISTS (SELECT 1 FROM walk w WHERE w.node = p.a AND w.ancestor = p.b) THEN 1 ELSE 0 END AS relation FROM p""")
def hyponym_test(spark, d):
    pairs = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("a"), F.concat(F.lit("r"), F.col("c_custkey") % 5).alias("b"))
    return graphs.is_a(A.edges(spark, d), pairs)


@query("", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice < 1000 THEN 'error' WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'P' THEN 'running' ELSE 'queued' END AS status FROM orders""")
def job_status(spark, d):
    """The first state in order of precedence."""
    s = F.col("o_orderstatus")
    status = F.when((s == "F") & (F.col("o_totalprice") < 1000), "error").when(s == "F", "finished").when(s == "P", "running").otherwise("queued")
    return table(spark, d, "orders").select("o_orderkey", status.alias("status"))


@query("", "SELECT o_custkey, min(o_orderkey) AS head, count(*) AS waiting, round(sum(o_totalprice), 2) AS cost FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey")
def queue_head(spark, d):
    """The head of each user's queue."""
    return table(spark, d, "orders").where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("head"), F.count("*").alias("waiting"), F.round(F.sum("o_totalprice"), 2).alias("cost"))


@query("", """SELECT n_name, r_name, count(DISTINCT c_custkey) AS customers, count(DISTINCT s_suppkey) AS suppliers FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name, r_name""")
def chain_joins(spark, d):
    """A chain of inner and outer joins; each side is counted before it joins."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("c"))
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("s"))
    both = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).join(c, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return both.select("n_name", "r_name", F.coalesce("c", F.lit(0)).alias("customers"), F.coalesce("s", F.lit(0)).alias("suppliers"))


@query("", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def runlog_replay(spark, d):
    """The last state of each key; a max of structs, so map tasks keep one row per key."""
    last = F.max(F.struct("ts", "event_id", "event_type")).alias("m")
    return table(spark, d, "events").groupBy("user_id").agg(last).select("user_id", F.col("m.event_type").alias("event_type"), F.col("m.event_id").alias("event_id"))


@query("", "WITH ab AS (SELECT p_partkey, list_distinct(string_split(p_name, ' ')) AS a, list_distinct(string_split(p_type, ' ')) AS b FROM part) SELECT p_partkey, array_to_string(list_sort(list_concat(list_filter(a, lambda x: NOT list_contains(b, x)), list_filter(b, lambda x: NOT list_contains(a, x)))), ',') AS changed, array_to_string(list_sort(list_intersect(a, b)), ',') AS kept FROM ab")
def option_lists(spark, d):
    """What only one of two lists has, and what both have, without regard to order."""
    a, b = (F.array_distinct(F.split(c, " ")) for c in ("p_name", "p_type"))
    changed = F.array_sort(F.concat(F.array_except(a, b), F.array_except(b, a)))
    return table(spark, d, "part").select("p_partkey", F.array_join(changed, ",").alias("changed"), F.array_join(F.array_sort(F.array_intersect(a, b)), ",").alias("kept"))


@query("", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("", """SELECT time_bucket(INTERVAL '1 hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def hourly_events(spark, d):
    """Ours, not the reference's: event-time windows as a stream would keep them, run to the end of the table."""
    return events.hourly_batch(table(spark, d, "events"))


@query("feat", "SELECT id, seqid, s, e FROM (SELECT *, row_number() OVER (PARTITION BY seqid ORDER BY score DESC, id) AS n FROM feat WHERE source = 'N') WHERE n = 1")
def best_per_contig(spark, d):
    f = A.feat(spark, d).where("source = 'N'")
    return selection.first_rows(f, ["seqid"], [F.desc("score"), F.col("id")]).select("id", "seqid", "s", "e")
