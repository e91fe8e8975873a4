"""Queries on sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusframe.functions import attributes, sequences
from locusframe.operators import intervals
from locusframe.plans.interval_queries import _pieces
from locusframe.plans.registry import query, table
from locusframe.sources import adapters as A

_CODONS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in sorted(sequences.codon_table().items())) + "}"


def _aa(offset: int) -> str:
    return f"array_to_string(list_transform(regexp_extract_all(substr(seq, {offset + 1}), '...'), lambda c: coalesce({_CODONS}[c], 'X')), '')"


@query("seqs", "SELECT seqid, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS rc FROM seqs")
def revcomp(spark, d):
    return A.seqs(spark, d).select("seqid", F.md5(sequences.reverse_complement(F.col("seq"))).alias("rc"))


@query("seqs", f"SELECT seqid, md5({_aa(1)}) AS protein, (length(seq) - 1) // 3 AS residues FROM seqs WHERE length(seq) > 0")
def translate_frame(spark, d):
    p = sequences.translate(F.col("seq"), 1)
    return A.seqs(spark, d).where("length(seq) > 0").select("seqid", F.md5(p).alias("protein"), F.expr("(length(seq) - 1) div 3").alias("residues"))


_ORF = """, fr AS (""" + " UNION ALL ".join(f"SELECT seqid, {f} AS f, string_split({_aa(f)}, '*') AS runs FROM seqs" for f in range(3)) + """),
    ru AS (SELECT seqid, f, unnest(runs) AS p, generate_subscripts(runs, 1) AS k FROM fr),
    po AS (SELECT *, f + 3 * coalesce(sum(length(p) + 1) OVER (PARTITION BY seqid, f ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM ru)
    SELECT seqid, md5(p) AS peptide, off::INT AS "offset" FROM (SELECT *, row_number() OVER (PARTITION BY seqid ORDER BY length(p) DESC, off) AS r FROM po) WHERE r = 1"""


@query("seqs", _ORF)
def longest_orf(spark, d):
    orf = sequences.longest_orf(F.col("seq"))
    return A.seqs(spark, d).withColumn("orf", orf).select("seqid", F.md5("orf.peptide").alias("peptide"), F.col("orf.offset").alias("offset"))


@query("seqs", """SELECT code, count(*) AS n FROM (SELECT CASE WHEN d || a IN ('GTAG', 'ATAC') THEN '+' WHEN d || a IN ('CTAC', 'GTAT') THEN '-' ELSE '0' END AS code
    FROM (SELECT substr(seq, 1 + k, 2) AS d, substr(seq, 50 + k, 2) AS a FROM (SELECT seq, unnest(range(0, length(seq) - 51)) AS k FROM seqs))) GROUP BY code""")
def splice_code(spark, d):
    """X11: the codes of every 51-base span's first and last two bases, counted by look-ahead in one pass."""
    found = lambda pairs: F.sum(F.regexp_count("seq", F.lit("(?=" + "|".join(f"{x}.{{47}}{y}" for x, y in pairs) + ")")))
    s = A.seqs(spark, d).where("length(seq) > 51").withColumn("seq", F.expr("left(seq, length(seq) - 1)"))
    row = s.agg(F.sum(F.length("seq") - 50).alias("all"), found(sequences.SPLICE["+"]).alias("plus"), found(sequences.SPLICE["-"]).alias("minus"))
    codes = F.array(*[F.struct(F.lit(c).alias("code"), n.cast("long").alias("n")) for c, n in (("+", F.col("plus")), ("-", F.col("minus")), ("0", F.col("all") - F.col("plus") - F.col("minus")))])
    return row.select(F.explode(codes).alias("x")).select("x.*").where("n > 0")


@query("seqs", "SELECT seqid, substr(seq, 11, 60) AS sub FROM seqs WHERE length(seq) >= 70")
def subseq(spark, d):
    return A.seqs(spark, d).where("length(seq) >= 70").select("seqid", F.substring("seq", 11, 60).alias("sub"))


@query("seqs", "SELECT seqid, o + 1 AS s, o + 100 AS e, substr(seq, o + 2, 100) AS tile FROM (SELECT seqid, seq, unnest(range(0, length(seq) - 100, 50)) AS o FROM seqs)")
def tiles(spark, d):
    t = sequences.tiles(A.seqs(spark, d), 100, 50)
    return t.select("seqid", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"), "tile")


@query("seqs", "SELECT seqid, k AS piece, substr(seq, k * 200 + 1, 200) AS part FROM (SELECT seqid, seq, unnest(range(0, (length(seq) + 199) // 200)) AS k FROM seqs)")
def break_seq(spark, d):
    return sequences.broken(A.seqs(spark, d), 200).withColumn("piece", F.col("piece").cast("long"))


@query("seqs", """, c AS (SELECT seqid, unnest(string_split(seq, '')) AS nt FROM seqs WHERE seq <> '')
    SELECT seqid, nt, count(*) AS n FROM c GROUP BY GROUPING SETS ((seqid, nt), (nt))""")
def nt_count(spark, d):
    """Letters per sequence and overall (seqid null); counted by length differences, without a row per letter."""
    s = A.seqs(spark, d)
    counts = F.array(*[F.struct(F.lit(x).alias("nt"), (F.length("seq") - F.length(F.replace("seq", F.lit(x), F.lit("")))).cast("long").alias("n")) for x in "ACGT"])
    rows = s.select("seqid", F.explode(counts).alias("c")).select("seqid", "c.nt", "c.n").where("n > 0")
    return rows.groupBy("seqid", "nt").agg(F.sum("n").alias("n")).unionByName(rows.groupBy("nt").agg(F.sum("n").alias("n")).withColumn("seqid", F.lit(None).cast("long")))


@query("seqs", "SELECT source, count(*) AS n, sum(length(seq))::BIGINT AS total, min(length(seq)) AS shortest, max(length(seq)) AS longest FROM seqs GROUP BY source")
def seq_length(spark, d):
    n = F.length("seq").cast("long")
    return A.seqs(spark, d).groupBy("source").agg(F.count("*").alias("n"), F.sum(n).alias("total"), F.min(n).alias("shortest"), F.max(n).alias("longest"))


@query("seqs", """, r AS (SELECT source, length(seq) AS n, seqid, sum(length(seq)) OVER (PARTITION BY source ORDER BY length(seq) DESC, seqid ROWS UNBOUNDED PRECEDING) AS c, lag(length(seq)) OVER (PARTITION BY source ORDER BY length(seq) DESC, seqid) AS p, sum(length(seq)) OVER (PARTITION BY source) AS t FROM seqs)
    SELECT source, CASE WHEN 2 * c = t THEN n ELSE floor((n + coalesce(p, 0)) / 2 + 0.5) END::INT AS n50 FROM r WHERE 2 * c >= t AND 2 * (c - n) < t""")
def n50(spark, d):
    return sequences.n50(A.seqs(spark, d), ["source"])


@query("seqs", "SELECT seqid, length(seq) AS n FROM seqs WHERE length(seq) > 800 AND length(seq) <= 2000")
def len_filter(spark, d):
    n = F.length("seq").cast("long")
    return A.seqs(spark, d).where((n > 800) & (n <= 2000)).select("seqid", n.alias("n"))


@query("seqs", "SELECT seqid FROM seqs WHERE regexp_matches(seq, 'GATTACA') AND NOT regexp_matches(seq, 'TTTTTTTT')")
def grep_seq(spark, d):
    return A.seqs(spark, d).where(F.col("seq").rlike("GATTACA") & ~F.col("seq").rlike("T{8}")).select("seqid")


@query("seqs", "SELECT seqid, n FROM (SELECT min(seqid) AS seqid, count(*) AS n FROM seqs GROUP BY seq)")
def uniq_seq(spark, d):
    return A.seqs(spark, d).groupBy("seq").agg(F.min("seqid").alias("seqid"), F.count("*").alias("n")).select("seqid", "n")


@query("seqs", """, u AS (SELECT min(seqid) AS seqid, seq FROM seqs WHERE seq IS NOT NULL GROUP BY seq)
    SELECT seqid FROM u a WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.seqid <> a.seqid AND length(b.seq) > length(a.seq) AND contains(b.seq, a.seq))""")
def uniq_sub(spark, d):
    """U4 for sequences of any length."""
    return sequences.not_contained(A.seqs(spark, d))


@query("", "SELECT doc_id, md5(upper(regexp_replace(regexp_replace(text, '[ *]', '', 'g'), '[^A-Za-z]', 'C', 'g'))) AS fixed FROM documents")
def fix_prot(spark, d):
    x = F.upper(F.regexp_replace(F.regexp_replace("text", "[ *]", ""), "[^A-Za-z]", "C"))
    return table(spark, d, "documents").select("doc_id", F.md5(x).alias("fixed"))


@query("attrs", "SELECT id, regexp_extract(attr, 'ID=([^;]*)', 1) AS feature, string_split(regexp_extract(attr, 'Parent=([^;]*)', 1), ',')[1] AS first_parent, len(string_split(regexp_extract(attr, 'Parent=([^;]*)', 1), ',')) AS parents, regexp_extract(attr, 'Note=([^;]*)', 1) AS note FROM attrs")
def attr_parse(spark, d):
    bag = attributes.parse(F.col("attr"))
    return A.attrs(spark, d).withColumn("bag", bag).select("id", F.expr("bag['ID'][0]").alias("feature"), F.expr("bag['Parent'][0]").alias("first_parent"), F.expr("cast(size(bag['Parent']) as bigint)").alias("parents"), F.expr("bag['Note'][0]").alias("note"))


@query("attrs", "SELECT id, attr AS rendered FROM attrs")
def attr_render(spark, d):
    return A.attrs(spark, d).select("id", attributes.render(attributes.parse(F.col("attr"))).alias("rendered"))


@query("attrs", "SELECT id, unnest(string_split(regexp_extract(attr, 'Parent=([^;]*)', 1), ',')) AS parent FROM attrs")
def explode_parents(spark, d):
    return A.attrs(spark, d).select("id", F.explode(attributes.parse(F.col("attr"))["Parent"]).alias("parent"))


@query("", "SELECT p_partkey, upper(md5(p_name))[1:2] || '/' || upper(md5(p_name))[3:4] || '/' || p_name AS path FROM part")
def md5_path(spark, d):
    return table(spark, d, "part").select("p_partkey", attributes.md5_path(F.col("p_name")).alias("path"))


@query("", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate::DATE AS day, (l_quantity::BIGINT + l_linenumber)::BIGINT AS matched, l_linenumber::BIGINT AS inserted FROM lineitem")
def cigar_parse(spark, d):
    gap = F.concat(F.lit("M"), F.col("l_quantity").cast("int"), F.lit(" I"), "l_linenumber", F.lit(" M"), "l_linenumber")
    ops = attributes.cigar(gap)
    total = lambda op: F.aggregate(F.filter(ops, lambda x: x["op"] == op), F.lit(0).cast("long"), lambda a, x: a + x["len"])
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), total("M").alias("matched"), total("I").alias("inserted"))


_MASK = """, f1 AS (SELECT seqid, s - 1000 AS s, e - 1000 AS e FROM feat WHERE s > 1000), """ + _pieces("f1", "seqid")


@query("feat seqs", _MASK + """, j AS (SELECT seqid, seq, p.s, least(p.e, length(seq)) AS e FROM seqs LEFT JOIN pieces p USING (seqid)),
    k AS (SELECT seqid, any_value(seq) AS seq, list(struct_pack(s := s, e := e) ORDER BY s) FILTER (s <= length(seq)) AS ps FROM j GROUP BY seqid)
    SELECT seqid, md5(array_to_string(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN len(list_filter(coalesce(ps, []), lambda p: i BETWEEN p.s AND p.e)) > 0 THEN 'N' ELSE substr(seq, i, 1) END), '')) AS masked,
      coalesce(list_sum(list_transform(ps, lambda p: p.e - p.s + 1)), 0)::INT AS n_masked FROM k""")
def mask(spark, d):
    """Sequences with merged features as N."""
    f = A.feat(spark, d).where("s > 1000").select("seqid", (F.col("s") - 1000).alias("s"), (F.col("e") - 1000).alias("e"))
    return sequences.masked(A.seqs(spark, d), intervals.merge(f, ["seqid"])).select("seqid", F.md5("seq").alias("masked"), (F.length("seq") - F.length(F.replace("seq", F.lit("N"), F.lit("")))).alias("n_masked"))
