"""Queries on output formats, reading frames, splice sites and sets of genes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from locusframe.functions import sequences
from locusframe.operators import graphs, intervals, selection
from locusframe.plans.interval_queries import SK, _after, _pieces
from locusframe.plans.registry import query, table
from locusframe.plans.sequence_queries import _aa
from locusframe.sources import adapters as A
from locusframe.sources import fasta, gff3

_ISO = """bo AS (SELECT *, max(e) OVER (PARTITION BY hit, seqid, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM hsps_q),
    bi AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY hit, seqid, strand ORDER BY s, e, p NULLS FIRST ROWS UNBOUNDED PRECEDING) AS i FROM bo),
    ex AS (SELECT seqid || CASE WHEN strand > 0 THEN 'p' ELSE 'm' END AS gene, hit || CASE WHEN strand > 0 THEN 'p' ELSE 'm' END AS tr, hit, seqid, strand, min(s) AS s, max(e) AS e FROM bi GROUP BY hit, seqid, strand, i),
    sp AS (SELECT gene, tr, hit, seqid, strand, min(s) AS s, max(e) AS e FROM ex GROUP BY ALL),
    cd AS (SELECT tr, s + 30 AS cs, e - 30 AS ce FROM sp WHERE hit % 4 <> 0 AND e - s > 90)"""


def _isoforms(spark, d):
    """Every hit as a transcript of its contig's and strand's gene: transcripts, exons, coding spans; every fourth hit is non-coding."""
    side = F.when(F.col("strand") > 0, "p").otherwise("m")
    blocks = intervals.merge(A.hsps(spark, d, exact=True), ["hit", *SK], rows=A.n_feat(spark, d))
    exons = blocks.select(F.concat(F.col("seqid"), side).alias("gene"), F.concat(F.col("hit"), side).alias("transcript"), "hit", *SK, "s", "e")
    spans = exons.groupBy("gene", "transcript", "hit", *SK).agg(F.min("s").alias("s"), F.max("e").alias("e"))
    coding = spans.where("hit % 4 <> 0 and e - s > 90").select("transcript", (F.col("s") + 30).alias("cs"), (F.col("e") - 30).alias("ce"))
    scores = spans.select("gene", "transcript", *SK, (F.col("hit") % 7 / 10).alias("aed"), (F.col("hit") % 9 / 10).alias("eaed"), F.concat_ws("|", F.col("hit") % 3, F.col("hit") % 5).alias("qi"))
    return scores, exons.select("transcript", "s", "e"), coding


_LINE = "concat_ws(chr(9), seqid, 'final', {kind}, s, e, '.', CASE WHEN strand > 0 THEN '+' ELSE '-' END, {phase}, {bag})"


@query(*_after("feat feat_q hsps_q", _ISO, f"""
    SELECT gene, 0 AS place, {_LINE.format(kind="'gene'", phase="'.'", bag="'ID=' || gene || ';Name=' || gene")} AS value FROM (SELECT gene, seqid, strand, min(s) AS s, max(e) AS e FROM ex GROUP BY ALL)
    UNION ALL SELECT gene, 1, {_LINE.format(kind="CASE WHEN cs IS NULL THEN 'ncRNA' ELSE 'mRNA' END", phase="'.'", bag="'ID=' || tr || ';Parent=' || gene || ';Name=' || tr || ';' || printf('_AED=%.2f;_eAED=%.2f;_QI=%s', hit % 7 / 10, hit % 9 / 10, concat_ws('|', hit % 3, hit % 5))")} FROM sp LEFT JOIN cd USING (tr)
    UNION ALL SELECT gene, 2, {_LINE.format(kind="'exon'", phase="'.'", bag="'ID=' || gene || ':exon:' || s || '-' || e || ';Parent=' || parents")} FROM (SELECT gene, seqid, strand, s, e, string_agg(DISTINCT tr, ',' ORDER BY tr) AS parents FROM ex GROUP BY ALL)
    UNION ALL SELECT gene, 3, {_LINE.format(kind="CASE WHEN five THEN 'five_prime_UTR' ELSE 'three_prime_UTR' END", phase="'.'", bag="'ID=' || tr || ':utr;Parent=' || tr")} FROM (
      SELECT gene, tr, seqid, strand, s, least(e, cs - 1) AS e, strand > 0 AS five FROM ex JOIN cd USING (tr) WHERE s < cs UNION ALL SELECT gene, tr, seqid, strand, greatest(s, ce + 1), e, strand < 0 FROM ex JOIN cd USING (tr) WHERE e > ce)
    UNION ALL SELECT gene, 4, {_LINE.format(kind="'CDS'", phase="phase", bag="'ID=' || tr || ':cds;Parent=' || tr")} FROM (
      SELECT *, ((-coalesce(sum(e - s + 1) OVER (PARTITION BY tr ORDER BY s * strand ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) % 3 + 3) % 3 AS phase FROM (SELECT gene, tr, seqid, strand, greatest(s, cs) AS s, least(e, ce) AS e FROM ex JOIN cd USING (tr) WHERE s <= ce AND cs <= e))"""))
def gene_block(spark, d):
    """K1, K4, K6, K8"""
    transcripts, exons, coding = _isoforms(spark, d)
    return gff3.gene_block(transcripts, exons, coding).select("gene", "place", "value")


@query(*_after("feat feat_q hsps_q", _ISO, """SELECT tr AS transcript, seqid, s, e, CASE WHEN n = 1 THEN 'Esngl' WHEN i = 1 THEN 'Einit' WHEN i = n THEN 'Eterm' ELSE 'Exon' END AS label
    FROM (SELECT *, row_number() OVER (PARTITION BY tr ORDER BY s * strand) AS i, count(*) OVER (PARTITION BY tr) AS n FROM ex)"""))
def zff_labels(spark, d):
    """Exons labelled by their place in the transcript."""
    transcripts, exons, _ = _isoforms(spark, d)
    w = Window.partitionBy("transcript")
    rows = exons.join(transcripts, "transcript").withColumns({"i": F.row_number().over(w.orderBy(F.col("s") * F.col("strand"))), "n": F.count("*").over(w)})
    label = F.when(F.col("n") == 1, "Esngl").when(F.col("i") == 1, "Einit").when(F.col("i") == F.col("n"), "Eterm").otherwise("Exon")
    return rows.select("transcript", "seqid", "s", "e", label.alias("label"))


@query(*_after("feat feat_q hsps_q", _ISO, """SELECT tr AS name, seqid::VARCHAR AS seqid, strand, s, e FROM ex"""))
def bed_round_trip(spark, d):
    """Transcripts as BED lines, and the lines read as blocks."""
    transcripts, exons, _ = _isoforms(spark, d)
    lines = gff3.bed_lines(exons.join(transcripts, "transcript"), ["transcript", *SK], "transcript")
    return gff3.bed_blocks(lines)


@query("", """SELECT CASE WHEN p_partkey IS NULL THEN doc_id::VARCHAR ELSE 'P' || p_partkey || ' ' || p_type END AS header, md5(text) AS body FROM documents LEFT JOIN part ON p_partkey = doc_id""")
def swap_ids(spark, d):
    """The whole header is replaced where the id is mapped."""
    seqs = table(spark, d, "documents").select(F.col("doc_id").alias("seqid"), F.lit("").alias("definition"), F.col("text").alias("seq"))
    names = table(spark, d, "part").select(F.col("p_partkey").alias("seqid"), F.concat(F.lit("P"), "p_partkey", F.lit(" "), "p_type").alias("new"))
    return fasta.renamed(seqs, names).select(F.col("seqid").alias("header"), F.md5("seq").alias("body"))


@query("feat", """, al AS (SELECT *, CASE WHEN source = 'R' THEN 0 WHEN source = 'A' THEN 1 ELSE 2 END AS file FROM feat), ft AS (SELECT file, okey, min(seqid) AS seqid, min(s) AS s, max(e) AS e FROM al GROUP BY file, okey)
    SELECT okey::VARCHAR AS id, file, s, e FROM ft WHERE file = (SELECT min(file) FROM ft o WHERE o.okey = ft.okey)""")
def merge_gff3(spark, d):
    """Three files' features (by return flag); of features with one id those of the first file stay."""
    f = A.feat(spark, d).withColumn("file_", F.when(F.col("source") == "R", 0).when(F.col("source") == "A", 1).otherwise(2))
    tops = f.groupBy("file_", "okey").agg(F.min("seqid").cast("string").alias("seqid"), F.min("s").alias("s"), F.max("e").alias("e"))
    rows = tops.select("file_", "seqid", F.lit("final").alias("source"), F.lit("match").alias("type"), "s", "e", F.create_map(F.lit("ID"), F.array(F.col("okey").cast("string"))).alias("attributes"))
    files = [rows.where(F.col("file_") == i).drop("file_") for i in range(3)]
    return gff3.merged(files).select(F.expr("attributes['ID'][0]").alias("id"), "file", "s", "e")


_FRAMES = """, fr AS (""" + " UNION ALL ".join(f"SELECT seqid, {f} AS f, string_split({_aa(f)}, '*') AS runs FROM seqs" for f in range(3)) + """),
    ru AS (SELECT seqid, f, unnest(runs) AS p, generate_subscripts(runs, 1) AS k, len(runs) AS m FROM fr),
    po AS (SELECT *, f + 3 * coalesce(sum(length(p) + 1) OVER (PARTITION BY seqid, f ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM ru)"""


@query("seqs", _FRAMES + """ SELECT seqid, md5(p || CASE WHEN k < m AND length(p) > 0 THEN '*' ELSE '' END) AS peptide, off::INT AS "offset" FROM (SELECT *, row_number() OVER (PARTITION BY seqid ORDER BY length(p) DESC, off) AS r FROM po) WHERE r = 1""")
def longest_orf_stop(spark, d):
    """The longest reading frame with its stop."""
    orf = sequences.longest_orf(F.col("seq"), with_stop=True)
    return A.seqs(spark, d).withColumn("orf", orf).select("seqid", F.md5("orf.peptide").alias("peptide"), F.col("orf.offset").alias("offset"))


@query("seqs", _FRAMES + """, ms AS (SELECT seqid, substr(p, strpos(p, 'M')) AS p, off + 3 * (strpos(p, 'M') - 1) AS off FROM po WHERE strpos(p, 'M') > 0)
    SELECT seqid, md5(coalesce(p, '')) AS peptide, coalesce(off, 0)::INT AS "offset" FROM seqs LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seqid ORDER BY length(p) DESC, off) AS r FROM ms) WHERE r = 1) USING (seqid)""")
def longest_m_orf(spark, d):
    """The longest reading frame from a start codon."""
    orf = sequences.longest_orf(F.col("seq"), start="M")
    return A.seqs(spark, d).withColumn("orf", orf).select("seqid", F.md5("orf.peptide").alias("peptide"), F.col("orf.offset").alias("offset"))


@query("seqs", _FRAMES.replace("FROM seqs", "FROM two").replace(", fr AS", """, two AS (SELECT seqid * 2 AS seqid, seq FROM seqs UNION ALL SELECT seqid * 2 + 1, reverse(translate(seq, 'ACGT', 'TGCA')) FROM seqs), fr AS""", 1) + """
    SELECT seqid // 2 AS seqid, md5(p) AS peptide, off::INT AS "offset", CASE WHEN seqid % 2 = 0 THEN 1 ELSE -1 END AS strand FROM (SELECT *, row_number() OVER (PARTITION BY seqid // 2 ORDER BY length(p) DESC, seqid % 2, off) AS r FROM po) WHERE r = 1""")
def two_strand_orf(spark, d):
    """The longest reading frame on both strands."""
    orf = sequences.longest_orf(F.col("seq"), both_strands=True)
    return A.seqs(spark, d).withColumn("orf", orf).select("seqid", F.md5("orf.peptide").alias("peptide"), F.col("orf.offset").alias("offset"), "orf.strand")


_JUNCTIONS = """, jn AS (SELECT seqid, k, substr(seq, 50 * k + 31, 2) AS donor, substr(seq, 50 * k + 49, 2) AS acceptor FROM (SELECT seqid, seq, unnest(range(0, (length(seq) - 30) // 50)) AS k FROM seqs))"""


def _junctions(spark, d):
    """Sequences read as exons of 30 letters every 50: donor and acceptor of each intron, without a row of text per intron."""
    n = F.greatest(F.expr("(length(seq) - 30) div 50"), F.lit(0)).cast("int")
    cut = F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda k: F.struct(k.alias("k"), F.substring("seq", k * 50 + 31, F.lit(2)).alias("donor"), F.substring("seq", k * 50 + 49, F.lit(2)).alias("acceptor")))
    return A.seqs(spark, d).select("seqid", F.explode(cut).alias("j")).select("seqid", "j.*")


@query("seqs", _JUNCTIONS + """, co AS (SELECT seqid, CASE WHEN donor || acceptor IN ('GTAG', 'ATAC') THEN '+' WHEN donor || acceptor IN ('CTAC', 'GTAT') THEN '-' ELSE '0' END AS c FROM jn)
    SELECT seqid, count_if(c = '+') AS plus, count_if(c = '-') AS minus, count_if(c = '0') AS other, count_if(c = '-') > count_if(c = '+') AS flip, count_if(c = '+') / count(*) < 0.75 AS bad FROM co GROUP BY seqid""")
def splice_counts(spark, d):
    """A sequence's junctions by code, whether they speak for the other strand, and whether too few are plus."""
    code = sequences.splice_code(F.col("donor"), F.col("acceptor"))
    n = lambda c: F.count_if(F.col("code") == c)
    return _junctions(spark, d).withColumn("code", code).groupBy("seqid").agg(n("+").alias("plus"), n("-").alias("minus"), n("0").alias("other"), (n("-") > n("+")).alias("flip"), (n("+") / F.count("*") < 0.75).alias("bad"))


@query("seqs", _JUNCTIONS + " SELECT donor, acceptor, donor IN ('GT', 'GC') AND acceptor = 'AG' AS valid, count(*) AS n FROM jn GROUP BY ALL")
def splice_sites(spark, d):
    """Donors and acceptors, and whether they are a valid pair."""
    valid = F.col("donor").isin("GT", "GC") & (F.col("acceptor") == "AG")
    return _junctions(spark, d).groupBy("donor", "acceptor", valid.alias("valid")).agg(F.count("*").alias("n"))


@query("seqs", "SELECT seqid, substr(seq, 21, 10) || '|' || substr(seq, 31, 10) AS donor, substr(seq, 41, 10) || '|' || substr(seq, 51, 10) AS acceptor FROM seqs WHERE length(seq) >= 60")
def splice_context(spark, d):
    """Ten bases before and behind a donor and an acceptor."""
    part = lambda a, b: F.concat(F.substring("seq", a, 10), F.lit("|"), F.substring("seq", b, 10))
    return A.seqs(spark, d).where("length(seq) >= 60").select("seqid", part(21, 31).alias("donor"), part(41, 51).alias("acceptor"))


@query("", "SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Z]{2,}'), ',') AS runs FROM documents")
def upper_runs(spark, d):
    """Runs of capitals."""
    return table(spark, d, "documents").select("doc_id", F.array_join(F.regexp_extract_all("text", F.lit("([A-Z]{2,})"), 1), ",").alias("runs"))


@query("", """SELECT doc_id, md5(regexp_replace(translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'XU', 'NT'), '[^ACGTN]', 'N', 'g')) AS clean, doc_id % 16 AS bin FROM documents""")
def clean_bins(spark, d):
    """Upper case, X and U as N and T, other letters as N, dealt in turn to 16 bins."""
    letters = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "XU", "NT")
    return table(spark, d, "documents").select("doc_id", F.md5(F.regexp_replace(letters, "[^ACGTN]", "N")).alias("clean"), (F.col("doc_id") % 16).alias("bin"))


@query("seqs", "SELECT seqid, md5(substr(seq, 1 + seqid % 50, 300)) AS coding FROM seqs")
def trim_utr(spark, d):
    """What stands from a header's offset on, 300 bases."""
    return A.seqs(spark, d).select("seqid", F.md5(F.substring("seq", (F.col("seqid") % 50 + 1).cast("int"), F.lit(300))).alias("coding"))


@query("seqs", "SELECT source, count(*) AS records, sum(length(seq))::BIGINT AS letters FROM seqs GROUP BY source")
def fasta_totals(spark, d):
    """S3, Z43"""
    return A.seqs(spark, d).groupBy("source").agg(F.count("*").alias("records"), F.sum(F.length("seq")).cast("long").alias("letters"))


_SETS = """, a AS (SELECT hit * 2 + CASE WHEN strand > 0 THEN 0 ELSE 1 END AS g, * FROM hits WHERE hit % 5 < 2), b AS (SELECT hit * 2 + CASE WHEN strand > 0 THEN 0 ELSE 1 END AS g, * FROM hits WHERE hit % 5 >= 2),
    ab AS (SELECT a.g AS x, b.g AS y, a.s = b.s AND a.e = b.e AS same FROM a JOIN b ON a.seqid = b.seqid AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e),
    dx AS (SELECT x, count(*) AS d FROM ab GROUP BY x), dy AS (SELECT y, count(*) AS d FROM ab GROUP BY y),
    cl AS (SELECT ab.x, bool_and(dy.d = 1) AS alone, max(dx.d) AS d, max(dy.d) AS most, bool_or(same) AS same FROM ab JOIN dx USING (x) JOIN dy USING (y) GROUP BY ab.x)"""


@query("feat hsps hits", _SETS + """ SELECT kind, count(*) AS n FROM (
    SELECT CASE WHEN cl.x IS NULL THEN 'MISSING' WHEN d = 1 AND alone THEN CASE WHEN same THEN 'SAME' ELSE 'REPLACE' END WHEN d > 1 AND alone THEN 'SPLIT' WHEN d = 1 THEN 'MERGE' ELSE 'COMPLEX' END AS kind FROM a LEFT JOIN cl ON cl.x = a.g
    UNION ALL SELECT 'NEW' FROM b WHERE g NOT IN (SELECT y FROM ab)) GROUP BY kind""")
def gene_set_classes(spark, d):
    """Genes of one set by how they meet the other's: missing, replaced one by one, split, merged, complex; and what is new there."""
    h = A.hits(spark, d).withColumn("g", F.col("hit") * 2 + F.when(F.col("strand") > 0, 0).otherwise(1))
    a, b = h.where("hit % 5 < 2"), h.where("hit % 5 >= 2")
    met = intervals.overlap_join(a.select(*SK, "s", "e", F.col("g").alias("x")), b.select(*SK, "s", "e", F.col("g").alias("y")), SK, bin_sizes=(64, 1024, 1 << 14))
    met = met.select("x", "y", ((F.col("s") == F.col("bs")) & (F.col("e") == F.col("be"))).alias("same"))
    of_x, of_y = met.groupBy("x").agg(F.count("*").alias("d")), met.groupBy("y").agg(F.count("*").alias("k"))
    per = met.join(of_x, "x").join(of_y, "y").groupBy("x").agg(F.bool_and(F.col("k") == 1).alias("alone"), F.max("d").alias("d"), F.bool_or("same").alias("same"))
    one = F.when(F.col("same"), "SAME").otherwise("REPLACE")
    kind = F.when(F.col("d").isNull(), "MISSING").when((F.col("d") == 1) & F.col("alone"), one).when(F.col("alone"), "SPLIT").when(F.col("d") == 1, "MERGE").otherwise("COMPLEX")
    old = a.join(per, F.col("g") == F.col("x"), "left").select(kind.alias("kind"))
    new = b.join(met.select(F.col("y").alias("g")).distinct(), "g", "left_anti").select(F.lit("NEW").alias("kind"))
    return old.union(new).groupBy("kind").agg(F.count("*").alias("n"))


@query(*_after("feat", "ab AS (SELECT * FROM feat a WHERE source = 'A' AND NOT EXISTS (SELECT 1 FROM feat b WHERE b.source = 'R' AND b.seqid = a.seqid AND b.s <= a.e AND a.s <= b.e)), " + _pieces("ab", "seqid"), """,
    rk AS (SELECT id, seqid, island, s, e, row_number() OVER (PARTITION BY seqid, island ORDER BY score DESC, id) AS r FROM _i),
    go AS (SELECT seqid, island, 1 AS r, [struct_pack(id := id, s := s, e := e)] AS kept FROM rk WHERE r = 1
      UNION ALL SELECT go.seqid, go.island, rk.r::INT, CASE WHEN len(list_filter(kept, lambda k: k.s <= rk.e AND rk.s <= k.e)) = 0 THEN list_append(kept, struct_pack(id := rk.id, s := rk.s, e := rk.e)) ELSE kept END FROM go JOIN rk ON rk.seqid = go.seqid AND rk.island = go.island AND rk.r = go.r + 1)
    SELECT seqid, unnest(kept).id AS id FROM (SELECT *, max(r) OVER (PARTITION BY seqid, island) AS last FROM go) WHERE r = last"""))
def abinit_left(spark, d):
    """Predictions that no final gene overlaps, then the best of those that overlap each other."""
    f = A.feat(spark, d)
    left = selection.unsupported(f.where("source = 'A'"), f.where("source = 'R'").select("seqid", "s", "e"), ["seqid"])
    return selection.greedy(left, ["seqid"], [F.desc("score"), F.col("id")], "id").select("seqid", "id")


@query(*_after("feat", "ev AS (SELECT * FROM feat WHERE source <> 'R'), " + _pieces("ev", "seqid, strand"), """ SELECT f.id, count(DISTINCT island) AS pieces, sum(p.n)::BIGINT AS members, least(min(f.s), min(p.s))::BIGINT AS s, greatest(max(f.e), max(p.e))::BIGINT AS e
    FROM feat f JOIN pieces p ON f.seqid = p.seqid AND f.strand = p.strand AND f.s <= p.e AND p.s <= f.e WHERE f.source = 'R' GROUP BY f.id"""))
def clusters_on_prediction(spark, d):
    """Per prediction, the union of the clusters that it overlaps."""
    f = A.feat(spark, d)
    pieces = intervals.merge(f.where("source <> 'R'"), SK)
    met = intervals.overlap_join(f.where("source = 'R'").select("id", *SK, "s", "e"), pieces, SK)
    return met.groupBy("id").agg(F.count("*").alias("pieces"), F.sum("n").alias("members"), F.least(F.min("s"), F.min("bs")).alias("s"), F.greatest(F.max("e"), F.max("be")).alias("e"))


@query("feat", "SELECT id, seqid, s, e FROM feat WHERE s BETWEEN 1000 AND 1500 AND source = 'A'")
def lines_for_chunk(spark, d):
    """Predictions whose start lies in a chunk."""
    return A.feat(spark, d).where("s between 1000 and 1500 and source = 'A'").select("id", "seqid", "s", "e")


@query("edges", """, walk AS (SELECT object AS node, subject AS below, 1 AS depth FROM edges UNION ALL SELECT w.node, e.subject, w.depth + 1 FROM walk w JOIN edges e ON w.below = e.object) SELECT node, max(depth) AS depth FROM walk GROUP BY node""")
def depth_to_leaf(spark, d):
    """The longest way down."""
    return graphs.leaves_below(A.edges(spark, d))
