"""Queries that choose, group and pass on evidence: by algorithm, by cluster, as hints and as report rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.functions import sequences
from locusframe.operators import clusters, evidence, intervals, ranks
from locusframe.plans.interval_queries import SK, _after, _pieces
from locusframe.plans.registry import query, table
from locusframe.shared import dealt
from locusframe.sources import adapters as A

_NAMES = "CASE sup % 5 WHEN 0 THEN 'est2genome' WHEN 1 THEN 'exonerate::protein2genome' WHEN 2 THEN 'snap_masked' WHEN 3 THEN 'snap:weight' ELSE 'est2genomeX' END"


def _named(spark, d):
    name = F.expr(_NAMES)
    return A.feat(spark, d).withColumn("algorithm", name)


@query("feat", f"SELECT algorithm, count(*) AS n FROM (SELECT {_NAMES} AS algorithm FROM feat) WHERE regexp_matches(lower(algorithm), '^(est2genome|protein2genome|snap)(:.*|_masked)?$|exonerate::(est2genome|protein2genome|snap)$') GROUP BY algorithm")
def selected_types(spark, d):
    """P19"""
    rows = _named(spark, d)
    return rows.where(evidence.selected(F.col("algorithm"), ["est2genome", "protein2genome", "snap"])).groupBy("algorithm").agg(F.count("*").alias("n"))


@query("feat", "SELECT id FROM feat WHERE s % 2 = 0 AND e - s > 10 AND source <> 'N'")
def user_predicate(spark, d):
    """a user's predicate, as a SQL expression."""
    return A.feat(spark, d).where("s % 2 = 0 and e - s > 10 and source <> 'N'").select("id")


@query(*_after("feat seqs", _pieces("feat", "seqid"), "SELECT p.seqid, p.s::BIGINT AS s, p.e::BIGINT AS e, substr(q.seq, p.s::INT, (p.e - p.s + 1)::INT) AS part FROM pieces p JOIN seqs q ON q.seqid = p.seqid WHERE p.s <= length(q.seq)"))
def piece_sequences(spark, d):
    """Merged pieces with their text."""
    p = intervals.merge(A.feat(spark, d), ["seqid"], rows=A.n_feat(spark, d)).select("seqid", "s", "e")
    n = (F.col("e") - F.col("s") + 1).cast("int")
    return p.join(A.seqs(spark, d).select("seqid", "seq"), "seqid").where("s <= length(seq)").select("seqid", "s", "e", F.substring("seq", F.col("s").cast("int"), n).alias("part"))


@query("feat hsps", """, ib AS (SELECT seqid, strand, unnest(range(e + 1, nx)) AS b FROM (SELECT seqid, strand, e, lead(s) OVER (PARTITION BY hit, strand ORDER BY s, e) AS nx FROM hsps) WHERE nx > e + 1),
    eb AS (SELECT DISTINCT seqid, strand, unnest(range(s, e + 1)) AS b FROM hsps), sp AS (SELECT seqid, strand, min(s) AS s, max(e) AS e FROM hsps GROUP BY ALL),
    ok AS (SELECT seqid, strand, b FROM (SELECT seqid, strand, unnest(range(s, e + 1)) AS b FROM sp) EXCEPT (SELECT seqid, strand, b FROM ib EXCEPT SELECT seqid, strand, b FROM eb)),
    nu AS (SELECT *, b - row_number() OVER (PARTITION BY seqid, strand ORDER BY b) AS g FROM ok)
    SELECT seqid, strand, min(b)::BIGINT AS s, max(b)::BIGINT AS e FROM nu GROUP BY seqid, strand, g""")
def intron_corrected(spark, d):
    """C1f: pieces of a contig's evidence that only bases which are nothing but intron break."""
    n = A.n_feat(spark, d)
    h = A.hsps(spark, d).select("hit", *SK, "s", "e")
    order = Window.partitionBy("hit", "strand").orderBy("s", "e")
    introns = dealt(h, ["hit", "strand"], n).select(*SK, (F.col("e") + 1).alias("s"), (F.lead("s").over(order) - 1).alias("e")).where("e >= s")
    exons = intervals.merge(h.select(*SK, "s", "e"), SK, rows=n).select(*SK, "s", "e")
    # neither exon nor intron: what lies between the pieces of both
    neither = intervals.gaps(intervals.merge(exons.union(introns), SK, rows=n), SK)
    return intervals.merge(exons.union(neither), SK, rows=n).select(*SK, "s", "e")


@query(*_after("feat", _pieces("feat", "seqid, strand", 15), "SELECT id, rank FROM (SELECT id, row_number() OVER (PARTITION BY seqid, strand, island ORDER BY id) AS rank FROM _i) WHERE rank <= 2"))
def shadow_first(spark, d):
    """The first hits of each shadow cluster in input order."""
    return clusters.shadow_clusters(A.feat(spark, d), SK, [F.col("id")], 2, 15).select("id", "rank")


@query(*_after("feat hsps hits", _pieces("hits", "seqid").replace("> p + 1", "> p"), "SELECT seqid, min(hit) AS component, count(*) AS hits, min(s) AS s, max(e) AS e FROM _i GROUP BY seqid, island"))
def clusters_any_strand(spark, d):
    """Components of spans whatever their strand."""
    labelled = intervals.islands(A.hits(spark, d), ["seqid"], name="_i", touch=0)
    return labelled.groupBy("seqid", "_i").agg(F.min("hit").alias("component"), F.count("*").alias("hits"), F.min("s").alias("s"), F.max("e").alias("e")).drop("_i")


@query(*_after("feat", "pr AS (SELECT * FROM feat WHERE source = 'R'), es AS (SELECT * FROM feat WHERE source = 'A'), " + _pieces("pr", "seqid, strand").replace("_o AS", "_po AS").replace("FROM _o", "FROM _po").replace("_i AS", "_pi AS").replace("FROM _i", "FROM _pi").replace("pieces AS", "pp AS") + """,
    att AS (SELECT es.id, count(*) AS n FROM es JOIN pp ON pp.seqid = es.seqid AND pp.strand = es.strand AND es.s <= pp.e AND pp.s <= es.e GROUP BY es.id),
    re AS (SELECT * FROM es WHERE id NOT IN (SELECT id FROM att)), """ + _pieces("re", "seqid, strand"),
    "SELECT id, 'attached' AS kind, n AS clusters, NULL::BIGINT AS cluster FROM att UNION ALL SELECT id, 'rest', 0, island::BIGINT FROM _i"))
def attached_ests(spark, d):
    """ESTs that meet protein clusters, and clusters of those that meet none."""
    f = A.feat(spark, d)
    pieces = intervals.merge(f.where("source = 'R'"), SK).select(*SK, "s", "e")
    ests = f.where("source = 'A'")
    met = intervals.overlap_join(ests.select("id", *SK, "s", "e"), pieces, SK).groupBy("id").agg(F.count("*").alias("clusters"))
    rest = intervals.islands(ests.join(met, "id", "left_anti").select("id", *SK, "s", "e"), SK, name="cluster")
    return met.select("id", F.lit("attached").alias("kind"), "clusters", F.lit(None).cast("long").alias("cluster")).union(rest.select("id", F.lit("rest"), F.lit(0).cast("long"), "cluster"))


@query(*_after("feat", _pieces("feat", "seqid, strand", 10), """, fl AS (SELECT *, source = 'R' AND e - s < 25 AS short FROM _i), ok AS (SELECT seqid, strand, island, count_if(source <> 'N' AND NOT short) AS left_ FROM fl GROUP BY ALL)
    SELECT id, source FROM fl JOIN ok USING (seqid, strand, island) WHERE NOT short AND (source <> 'N' OR left_ > 0)"""))
def purged_clusters(spark, d):
    """Short ESTs go from their clusters; predictions stay only beside evidence that is left."""
    labelled = intervals.islands(A.feat(spark, d), SK, 10, "cluster", rows=A.n_feat(spark, d))
    short = (F.col("source") == "R") & (F.col("e") - F.col("s") < 25)
    return evidence.purged(labelled, [*SK, "cluster"], short, F.col("source") == "N").select("id", "source")


@query("feat feat_q hsps_q", """, st AS (SELECT hit, seqid, strand, string_agg(s || '-' || e, ',' ORDER BY s, e) AS form, sum(score) AS score FROM hsps_q GROUP BY ALL)
    SELECT hit, strand FROM (SELECT *, row_number() OVER (PARTITION BY seqid, strand, form ORDER BY round(score, 2) DESC, hit) AS r FROM st) WHERE r = 1""")
def polished_once(spark, d):
    """F16: of alignments with one structure the best-scored stays."""
    h = A.hsps(spark, d, exact=True).groupBy("hit", *SK).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("form"), F.round(F.sum("score"), 2).alias("score"))
    best = h.groupBy(*SK, "form").agg(F.min(F.struct((-F.col("score")).alias("k"), "hit")).alias("m"))
    return best.select(F.col("m.hit").alias("hit"), "strand")


@query(*_after("feat hsps hits", _pieces("hsps", "hit, strand"), """, ln AS (SELECT hit, strand, sum(e - s + 1) AS exonic FROM pieces GROUP BY ALL), cd AS (SELECT p.hit, p.strand, sum(greatest(least(p.e, h.e - 100) - greatest(p.s, h.s + 100) + 1, 0)) AS coding FROM pieces p JOIN hits h USING (hit, strand) GROUP BY ALL)
    SELECT hit, strand, round(coding / exonic, 4) AS share FROM ln JOIN cd USING (hit, strand) WHERE coding / exonic >= CASE WHEN hit % 2 = 0 THEN 0.4 ELSE 0.8 END"""))
def coding_share(spark, d):
    """models whose coding bases (here all but 100 positions at either end) are 40 % of their exons, or 80 % for those from proteins (odd hits)."""
    pieces = intervals.merge(A.hsps(spark, d), ["hit", "strand"], rows=A.n_feat(spark, d))
    spans = A.hits(spark, d).select("hit", "strand", (F.col("s") + 100).alias("cs"), (F.col("e") - 100).alias("ce"))
    own, coding = F.col("e") - F.col("s") + 1, F.greatest(F.least("e", "ce") - F.greatest("s", "cs") + 1, F.lit(0))
    sums = pieces.join(spans, ["hit", "strand"]).groupBy("hit", "strand").agg((F.sum(coding) / F.sum(own)).alias("share"))
    return sums.where(F.col("share") >= F.when(F.col("hit") % 2 == 0, 0.4).otherwise(0.8)).select("hit", "strand", F.round("share", 4).alias("share"))


@query("feat hsps", """, it AS (SELECT hit, seqid, strand, e + 1 AS s, nx - 1 AS e FROM (SELECT hit, seqid, strand, e, lead(s) OVER (PARTITION BY hit, strand ORDER BY s, e, id) AS nx FROM hsps) WHERE nx > e + 1)
    SELECT concat_ws(chr(9), seqid, 'PROTEIN', 'CDSpart', s, e, '0', CASE WHEN strand > 0 THEN '+' ELSE '-' END, '.', 'source=P;pri=2') AS value FROM hsps WHERE source = 'R'
    UNION ALL SELECT concat_ws(chr(9), seqid, 'EST-INTRON', 'intron', s, e, '0', CASE WHEN strand > 0 THEN '+' ELSE '-' END, '.', 'source=E;pri=3') FROM it WHERE e - s >= 25
    UNION ALL SELECT concat_ws(chr(9), h.seqid, 'EST-EXON', 'exonpart', h.s, h.e, '0', CASE WHEN h.strand > 0 THEN '+' ELSE '-' END, '.', 'source=E;pri=1') FROM hsps h WHERE source = 'A' AND EXISTS (SELECT 1 FROM it WHERE it.seqid = h.seqid AND it.strand = h.strand)""")
def hint_rows(spark, d):
    """Hints for a predictor: coding parts, introns of 25 bases or more, and exon parts where there are introns."""
    h = A.hsps(spark, d)
    order = Window.partitionBy("hit", "strand").orderBy("s", "e", "id")
    introns = h.select(*SK, (F.col("e") + 1).alias("s"), (F.lead("s").over(order) - 1).alias("e")).where("e >= s")
    return evidence.hints(h.where("source = 'R'"), introns, h.where("source = 'A'"), SK)


@query(*_after("feat seqs", "ev AS (SELECT seqid, min(s) AS s, max(e) AS e FROM feat WHERE source = 'R' GROUP BY seqid)", "SELECT v.seqid, greatest(v.s - 50, 1) - 1 AS offset_, md5(substr(q.seq, greatest(v.s - 50, 1)::INT, (least(v.e + 50, length(q.seq)) - greatest(v.s - 50, 1) + 1)::INT)) AS part FROM ev v JOIN seqs q ON q.seqid = v.seqid WHERE v.s - 50 <= length(q.seq)"))
def hint_window(spark, d):
    """The evidence's span with 50 bases around it, as text and offset."""
    span = A.feat(spark, d).where("source = 'R'").groupBy("seqid").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    low, high = F.greatest(F.col("s") - 50, F.lit(1)), F.least(F.col("e") + 50, F.length("seq"))
    rows = span.join(A.seqs(spark, d).select("seqid", "seq"), "seqid").where("s - 50 <= length(seq)")
    return rows.select("seqid", (low - 1).alias("offset_"), F.md5(F.substring("seq", low.cast("int"), (high - low + 1).cast("int"))).alias("part"))


@query("feat", """SELECT seqid, hash_rank AS place, id FROM (SELECT seqid, id, row_number() OVER (PARTITION BY seqid ORDER BY md5(id)) AS hash_rank FROM feat) WHERE hash_rank <= 5""")
def sampled(spark, d):
    """Five records of each contig in an order that only their ids decide."""
    w = Window.partitionBy("seqid").orderBy(F.md5("id"))
    return A.feat(spark, d).select("seqid", F.row_number().over(w).alias("place"), "id").where("place <= 5")


@query("feat", "SELECT seqid, row_number() OVER (ORDER BY n DESC, length DESC, seqid) AS place, n, length FROM (SELECT seqid, count(*) AS n, max(e) AS length FROM feat GROUP BY seqid)")
def contig_order(spark, d):
    """Contigs by features, then length."""
    c = A.feat(spark, d).groupBy("seqid").agg(F.count("*").alias("n"), F.max("e").alias("length"))
    return ranks.numbered(c, [F.desc("n"), F.desc("length"), F.col("seqid")], "place").select("seqid", "place", "n", "length")


@query("feat", """, gn AS (SELECT okey, seqid, strand, min(s) AS s, max(e) AS e FROM feat GROUP BY okey, seqid, strand)
    SELECT a.okey, a.seqid, a.strand, max_by(b.okey, struct_pack(k := a.s - b.s, okey := -b.okey)) AS best FROM gn a JOIN gn b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e AND b.s < a.s AND a.okey <> b.okey GROUP BY a.okey, a.seqid, a.strand""")
def best_extension(spark, d):
    """Of the genes that run over a gene's begin, the one that reaches farthest."""
    g = A.feat(spark, d).groupBy("okey", *SK).agg(F.min("s").alias("s"), F.max("e").alias("e"))
    met = intervals.overlap_join(g, g.select(*SK, "s", "e", F.col("okey").alias("b_okey")), SK).where("bs < s and okey <> b_okey")
    return met.groupBy("okey", *SK).agg(F.max_by("b_okey", F.struct(F.col("s") - F.col("bs"), -F.col("b_okey"))).alias("best"))


@query("", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, c_name, n1.n_name AS buyer, r1.r_name AS buyer_region, s_name, n2.n_name AS seller, r2.r_name AS seller_region, p_name, source, quality, item_id
    FROM lineitem l JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation n1 ON n1.n_nationkey = c_nationkey JOIN region r1 ON r1.r_regionkey = n1.n_regionkey
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation n2 ON n2.n_nationkey = s_nationkey JOIN region r2 ON r2.r_regionkey = n2.n_regionkey JOIN part ON p_partkey = l_partkey
    LEFT JOIN documents d ON d.doc_id = l_partkey LEFT JOIN labels ON labels.doc_id = d.doc_id LEFT JOIN benchmark ON item_id = l_suppkey WHERE l_quantity > 45""")
def wide_join(spark, d):
    """Twelve tables, inner and left outer; the order is the optimiser's."""
    t = lambda name: table(spark, d, name)
    nation = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyer = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("buyer"), F.col("r_name").alias("buyer_region"))
    seller = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seller"), F.col("r_name").alias("seller_region"))
    rows = t("lineitem").where("l_quantity > 45").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(buyer, "c_nationkey")
    rows = rows.join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(seller, "s_nationkey").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.join(t("documents").select("doc_id", "source"), F.col("l_partkey") == F.col("doc_id"), "left").join(t("labels").select(F.col("doc_id").alias("label_id"), "quality"), F.col("doc_id") == F.col("label_id"), "left")
    rows = rows.join(t("benchmark").select("item_id"), F.col("l_suppkey") == F.col("item_id"), "left")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c_name", "buyer", "buyer_region", "s_name", "seller", "seller_region", "p_name", "source", "quality", "item_id")


@query("", """SELECT n_name, string_agg(DISTINCT s_name || ':' || s_suppkey, ',' ORDER BY s_name || ':' || s_suppkey) AS names FROM nation JOIN supplier ON s_nationkey = n_nationkey AND s_name <> n_name AND s_suppkey::VARCHAR || n_name <> '1' GROUP BY n_name""")
def attribute_lists(spark, d):
    """Attributes joined with residual predicates and put together per feature."""
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    both = n.join(s, (F.col("s_nationkey") == F.col("n_nationkey")) & (F.col("s_name") != F.col("n_name")) & (F.concat(F.col("s_suppkey").cast("string"), "n_name") != "1"))
    return both.groupBy("n_name").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "s_name", "s_suppkey"))), ",").alias("names"))


@query("", """SELECT p_partkey, concat(p_name, ' Name:"Similar to ', coalesce(s_name, 'unknown'), '"') AS header FROM part LEFT JOIN (SELECT l_partkey, min_by(l_suppkey, struct_pack(d := l_shipdate, o := l_orderkey, n := l_linenumber, s := l_suppkey)) AS k FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey LEFT JOIN supplier ON s_suppkey = k""")
def annotated_headers(spark, d):
    """Headers with the description of the first hit."""
    first = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.min(F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")).alias("m")).select("l_partkey", F.col("m.l_suppkey").alias("k"))
    rows = table(spark, d, "part").join(first, F.col("p_partkey") == F.col("l_partkey"), "left").join(table(spark, d, "supplier"), F.col("k") == F.col("s_suppkey"), "left")
    return rows.select("p_partkey", F.concat("p_name", F.lit(' Name:"Similar to '), F.coalesce("s_name", F.lit("unknown")), F.lit('"')).alias("header"))


@query("", """SELECT path, level, name FROM (SELECT lpad(r_regionkey::VARCHAR, 4, '0') AS path, 0 AS level, r_name AS name FROM region
    UNION ALL SELECT lpad(n_regionkey::VARCHAR, 4, '0') || '/' || lpad(n_nationkey::VARCHAR, 4, '0'), 1, n_name FROM nation
    UNION ALL SELECT lpad(n_regionkey::VARCHAR, 4, '0') || '/' || lpad(n_nationkey::VARCHAR, 4, '0') || '/' || lpad(s_suppkey::VARCHAR, 8, '0'), 2, s_name FROM supplier JOIN nation ON n_nationkey = s_nationkey)""")
def hierarchy_order(spark, d):
    """Parents before their children, by a path that sorts as it prints."""
    r, n, s = (table(spark, d, x) for x in ("region", "nation", "supplier"))
    key = lambda c, k: F.lpad(F.col(c).cast("string"), k, "0")
    of = F.concat_ws("/", key("n_regionkey", 4), key("n_nationkey", 4))
    rows = r.select(key("r_regionkey", 4).alias("path"), F.lit(0).alias("level"), F.col("r_name").alias("name")).union(n.select(of, F.lit(1), "n_name"))
    return rows.union(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.concat_ws("/", of, key("s_suppkey", 8)), F.lit(2), "s_name"))


@query("", "SELECT o_orderkey AS k, 'order' AS kind, o_totalprice AS price, NULL::BIGINT AS part FROM orders UNION ALL SELECT l_orderkey, 'line', NULL, l_partkey FROM lineitem")
def widened_schema(spark, d):
    """An older table joins a newer one, its missing columns null."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.lit("order").alias("kind"), F.col("o_totalprice").alias("price"))
    return o.unionByName(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.lit("line").alias("kind"), F.col("l_partkey").alias("part")), allowMissingColumns=True)


@query("feat", f"SELECT tool, masked, params, count(*) AS n FROM (SELECT regexp_extract(a, '^([a-z0-9]+?)(_masked)?(:|$)', 1) AS tool, a LIKE '%\\_masked%' ESCAPE '\\' AS masked, coalesce(nullif(regexp_extract(a, ':([^:]+)$', 1), ''), '-') AS params FROM (SELECT lower({_NAMES}) AS a FROM feat)) GROUP BY ALL")
def prediction_groups(spark, d):
    """Predictions by tool, masking and parameter file."""
    a = F.lower("algorithm")
    rows = _named(spark, d).select(F.regexp_extract(a, "^([a-z0-9]+?)(_masked)?(:|$)", 1).alias("tool"), F.contains(a, F.lit("_masked")).alias("masked"), F.coalesce(F.nullif(F.regexp_extract(a, ":([^:]+)$", 1), F.lit("")), F.lit("-")).alias("params"))
    return rows.groupBy("tool", "masked", "params").agg(F.count("*").alias("n"))


@query("feat hsps hits", """, gn AS (SELECT hit, seqid, strand, CASE WHEN hit % 5 = 0 THEN 'final' WHEN hit % 5 = 1 THEN 'snap' ELSE 'augustus' END AS algorithm, s, e FROM hits)
    SELECT hit, strand, CASE WHEN algorithm = 'final' THEN 'final' WHEN NOT EXISTS (SELECT 1 FROM gn f WHERE f.algorithm = 'final' AND f.seqid = gn.seqid AND f.s <= gn.e AND gn.s <= f.e) THEN 'non_overlapping' ELSE algorithm END AS file FROM gn""")
def fasta_groups(spark, d):
    """Which file each model's sequences go to: final, predictions that overlap no final model, or one per tool."""
    tool = F.when(F.col("hit") % 5 == 0, "final").when(F.col("hit") % 5 == 1, "snap").otherwise("augustus")
    g = A.hits(spark, d).select("hit", *SK, "s", "e", tool.alias("algorithm"))
    final = g.where("algorithm = 'final'")
    free = intervals.overlap_join(g.where("algorithm <> 'final'"), final.select("seqid", "s", "e"), ["seqid"], how="left_anti", bin_sizes=(64, 1024, 1 << 14)).select("hit", "strand").withColumn("free", F.lit(True))
    file = F.when(F.col("algorithm") == "final", "final").when(F.col("free"), "non_overlapping").otherwise(F.col("algorithm"))
    return g.join(free, ["hit", "strand"], "left").select("hit", "strand", file.alias("file"))


@query(*_after("feat hsps hits", _pieces("hits", "seqid, strand"), "SELECT hit, CASE WHEN score > 60000 THEN 'single:' || hit || ':' || strand WHEN n >= 4 THEN 'gene:' || seqid || ':' || strand ELSE 'cluster:' || seqid || ':' || strand || ':' || island END AS gene, strand FROM _i"))
def transcript_groups(spark, d):
    """Transcripts to genes by policy: alone, by gene id, or by cluster."""
    labelled = intervals.islands(A.hits(spark, d), SK, name="cluster")
    of = F.concat_ws(":", "seqid", "strand")
    gene = F.when(F.col("score") > 60000, F.concat_ws(":", F.lit("single"), "hit", "strand")).when(F.col("n") >= 4, F.concat_ws(":", F.lit("gene"), of)).otherwise(F.concat_ws(":", F.lit("cluster"), of, "cluster"))
    return labelled.select("hit", gene.alias("gene"), "strand")


@query(*_after("feat seqs", "ft AS (SELECT seqid, s, e, row_number() OVER (PARTITION BY seqid ORDER BY s, e, id) AS r FROM feat WHERE s <= 800), ps AS (SELECT seqid, list(struct_pack(s := s, e := e)) AS p FROM ft WHERE r > 1 GROUP BY seqid)",
    "SELECT q.seqid, md5(array_to_string(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN len(list_filter(coalesce(p, []), lambda x: i BETWEEN x.s AND x.e)) > 0 THEN 'N' ELSE substr(seq, i, 1) END), '')) AS masked FROM seqs q LEFT JOIN ps USING (seqid)"))
def masked_as_written(spark, d):
    """Sequences masked by features, of which the first of each sequence is passed over, as is done."""
    first = Window.partitionBy("seqid").orderBy("s", "e", "id")
    f = A.feat(spark, d).where("s <= 800").withColumn("r", F.row_number().over(first)).where("r > 1")
    return sequences.masked(A.seqs(spark, d), intervals.merge(f, ["seqid"])).select("seqid", F.md5("seq").alias("masked"))
