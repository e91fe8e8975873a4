"""Readers of other tools' reports: one projection or explode per format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusframe.functions.attributes import parse

#: Methods of domain reports that are skipped, and the database names of the others.
SKIPPED_METHODS = ["Seg", "Coils", "TMHMM", "SignalP", "MobiDBLite", "Phobius"]
DATABASES = {"HMMPfam": "PFAM", "Pfam": "PFAM", "ProDom": "PRODOM", "Gene3D": "CATHGENE3D", "SuperFamily": "SUPERFAMILY", "PRINTS": "PRINTS", "SMART": "SMART", "TIGRFAM": "JCVI_TIGRFAMS", "PANTHER": "PANTHER"}


def _fields(spark: SparkSession, path: str, separator: str = r"\s+", comment: str = "^\\s*(#|$)") -> tuple[DataFrame, Column]:
    rows = spark.read.text(path).where(~F.col("value").rlike(comment))
    return rows, F.split(F.trim("value"), separator)


def number(c: Column) -> Column:
    """Text as a number; e-10 reads as 1e-10."""
    return F.regexp_replace(c, "^e", "1e").try_cast("double")


def blast_table(spark: SparkSession, path: str) -> DataFrame:
    """A 24-column table as alignment blocks: qid, sid, evalue, bits, score, identity, q_start, q_end, s_start, s_end."""
    rows, f = _fields(spark, path)
    return rows.select(f[0].alias("qid"), f[1].alias("sid"), number(f[2]).alias("evalue"), number(f[4]).alias("bits"), number(f[5]).alias("score"), (number(f[10]) / 100).alias("identity"), f[17].cast("long").alias("q_start"), f[18].cast("long").alias("q_end"), f[20].cast("long").alias("s_start"), f[21].cast("long").alias("s_end"))


def repeatmasker(spark: SparkSession, path: str) -> DataFrame:
    """Score, seqid, s, e, strand, name, kind (simple or te)."""
    rows, f = _fields(spark, path)
    rows = rows.where(f[0].rlike(r"^\d+$"))
    family = f[10]
    return rows.select(f[0].cast("double").alias("score"), f[4].alias("seqid"), f[5].cast("long").alias("s"), f[6].cast("long").alias("e"), F.when(f[8] == "C", -1).otherwise(1).alias("strand"), f[9].alias("name"), family.alias("family"), F.when(family.rlike("Simple_repeat|Low_complexity|Satellite"), "simple").otherwise("te").alias("kind"))


def augustus(spark: SparkSession, path: str) -> DataFrame:
    """Coding blocks with their transcript and the gene's score."""
    rows, f = _fields(spark, path, "\t")
    rows = rows.where(F.size(f) >= 9)
    name = lambda key: F.regexp_extract(f[8], f'{key} "?([^";]+)"?', 1)
    cds = rows.where(f[2] == "CDS").select(f[0].alias("seqid"), f[3].cast("long").alias("s"), f[4].cast("long").alias("e"), F.when(f[6] == "-", -1).otherwise(1).alias("strand"), name("transcript_id").alias("transcript"), name("gene_id").alias("gene"))
    genes = rows.where(f[2] == "gene").select(f[8].alias("gene"), number(f[5]).alias("score"))
    return cds.join(genes, "gene", "left")


def snap(spark: SparkSession, path: str) -> DataFrame:
    """Label, s, e, strand, score, model; a header line names the contig of the lines below it.

    The contig is carried within a file, whose lines keep their order by file offset."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("i", "line"), F.input_file_name().alias("file"))
    order = Window.partitionBy("file").orderBy("i")
    rows = rows.withColumn("seqid", F.last(F.when(F.col("line").startswith(">"), F.regexp_extract("line", r"^>(\S+)", 1)), ignorenulls=True).over(order))
    f = F.split(F.trim("line"), r"\s+")
    rows = rows.where(~F.col("line").startswith(">") & (F.size(f) >= 9))
    return rows.select("seqid", f[0].alias("label"), f[1].cast("long").alias("s"), f[2].cast("long").alias("e"), F.when(f[3] == "-", -1).otherwise(1).alias("strand"), number(f[4]).alias("score"), f[8].alias("model"))


def trnascan(spark: SparkSession, path: str) -> DataFrame:
    """Exons of tRNAs; an intron cuts one in two, an undetermined codon is NNN, the strand is the direction."""
    rows, f = _fields(spark, path, "\t")
    f = F.transform(f, lambda x: F.trim(x))
    rows = rows.where(f[1].rlike(r"^\d+$"))
    b, e = f[2].cast("long"), f[3].cast("long")
    ib, ie = f[6].cast("long"), f[7].cast("long")
    s, t, si, ti = F.least(b, e), F.greatest(b, e), F.least(ib, ie), F.greatest(ib, ie)
    blocks = F.when(ib == 0, F.array(F.struct(s.alias("s"), t.alias("e")))).otherwise(F.array(F.struct(s.alias("s"), (si - 1).alias("e")), F.struct((ti + 1).alias("s"), t.alias("e"))))
    codon = F.when(f[5].isin("???", "Undet"), "NNN").otherwise(f[5])
    out = rows.select(f[0].alias("seqid"), F.concat_ws("-", f[4], codon).alias("name"), F.when(b > e, -1).otherwise(1).alias("strand"), f[8].cast("double").alias("score"), F.explode(blocks).alias("x"))
    return out.select("seqid", "name", "strand", "score", "x.s", "x.e")


def domains(spark: SparkSession, path: str) -> DataFrame:
    """Protein domains: seq_id, database, accession, s, e, evalue, ipr, go (the first id only)."""
    rows, f = _fields(spark, path, "\t")
    table = F.create_map(*[F.lit(x) for kv in DATABASES.items() for x in kv])
    return rows.where(~f[3].isin(SKIPPED_METHODS)).select(f[0].alias("seq_id"), F.coalesce(F.try_element_at(table, f[3]), F.upper(f[3])).alias("database"), f[4].alias("accession"), f[6].cast("long").alias("s"), f[7].cast("long").alias("e"), number(f[8]).alias("evalue"), F.nullif(F.get(f, 11), F.lit("")).alias("ipr"), F.nullif(F.regexp_extract(F.coalesce(F.get(f, 13), F.lit("")), r"(GO:\d+)", 1), F.lit("")).alias("go"))


def bed_junctions(spark: SparkSession, path: str) -> DataFrame:
    """Junction lines as a match with two parts: id, seqid, strand, part (0 the match), s, e."""
    rows, f = _fields(spark, path, "\t", "^(track|\\s*$|#)")
    sizes, starts = F.split(f[10], ","), F.split(f[11], ",")
    begin = f[1].cast("long") + 1
    part = lambda i: F.struct(F.lit(i + 1).alias("part"), (begin + starts[i].cast("long")).alias("s"), (begin + starts[i].cast("long") + sizes[i].cast("long") - 1).alias("e"))
    blocks = F.array(F.struct(F.lit(0).alias("part"), begin.alias("s"), f[2].cast("long").alias("e")), part(0), part(1))
    return rows.select(f[3].alias("id"), f[0].alias("seqid"), F.when(f[5] == "-", -1).otherwise(1).alias("strand"), F.explode(blocks).alias("x")).select("id", "seqid", "strand", "x.*")


def gtf_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Transcript blocks with the place of each in the transcript (t_start, t_end); those without a strand go."""
    rows, f = _fields(spark, path, "\t")
    name = F.regexp_extract(f[8], 'transcript_id "([^"]+)"', 1)
    exons = rows.where((f[2] == "exon") & f[6].isin("+", "-")).select(f[0].alias("seqid"), name.alias("transcript"), F.when(f[6] == "-", -1).otherwise(1).alias("strand"), f[3].cast("long").alias("s"), f[4].cast("long").alias("e"))
    order = Window.partitionBy("seqid", "transcript").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("e") - F.col("s") + 1).over(order)
    return exons.withColumn("t_end", end).withColumn("t_start", F.col("t_end") - (F.col("e") - F.col("s")))


def gtf_models(spark: SparkSession, path: str) -> DataFrame:
    """Genes, transcripts, exons and CDS from coding blocks alone: gene, transcript, type, s, e."""
    rows, f = _fields(spark, path, "\t")
    name = lambda key: F.regexp_extract(f[8], f'{key} "([^"]+)"', 1)
    cds = rows.where(f[2] == "CDS").select(f[0].alias("seqid"), name("gene_id").alias("gene"), name("transcript_id").alias("transcript"), F.when(f[6] == "-", -1).otherwise(1).alias("strand"), f[3].cast("long").alias("s"), f[4].cast("long").alias("e"))
    span = lambda keys, kind: cds.groupBy("seqid", "strand", *keys).agg(F.min("s").alias("s"), F.max("e").alias("e")).withColumn("type", F.lit(kind))
    parts = cds.withColumn("type", F.lit("CDS")).unionByName(cds.withColumn("type", F.lit("exon")))
    return parts.unionByName(span(["gene", "transcript"], "mRNA")).unionByName(span(["gene"], "gene"), allowMissingColumns=True)


def obo(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """An ontology's nodes (id, name) and edges (subject, object, type)."""
    stanzas = spark.read.option("lineSep", "\n[").text(path).where(F.col("value").rlike("^\\[?Term\\]")).where(~F.col("value").rlike("(?m)^is_obsolete: true"))
    ident = F.regexp_extract("value", r"(?m)^id: (\S+)", 1)
    nodes = stanzas.select(ident.alias("id"), F.regexp_extract("value", r"(?m)^name: (.+?)\s*$", 1).alias("name"))
    parents = F.transform(F.regexp_extract_all("value", F.lit(r"(?m)^is_a: (\S+)"), 1), lambda x: F.struct(F.lit("isa").alias("type"), x.alias("object")))
    others = F.transform(F.regexp_extract_all("value", F.lit(r"(?m)^relationship: (\S+ \S+)"), 1), lambda x: F.struct(F.substring_index(x, " ", 1).alias("type"), F.substring_index(x, " ", -1).alias("object")))
    edges = stanzas.select(ident.alias("subject"), F.explode(F.concat(parents, others)).alias("r")).select("subject", "r.object", "r.type")
    return nodes, edges


def uniprot_headers(c: Column) -> Column:
    """Name, organism and gene of a protein header, in any of three styles."""
    style = lambda pattern: F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    name = F.coalesce(style(r"^\S+\s+(.+?)\s+OS="), style(r"^\S+\s+(.+?)\s+n=\d+\s+Tax="), style(r"^\S+\s+(.+)$"))
    return F.struct(name.alias("name"), F.coalesce(style(r"OS=(.+?)(?:\s+\w\w=|$)"), style(r"Tax=(.+?)(?:\s+\w+=|$)")).alias("organism"), style(r"GN=(\S+)").alias("gene"))


def gtf_attributes(c: Column) -> Column:
    """GTF's key "value"; pairs as the GFF3 bag."""
    return parse(F.regexp_replace(F.regexp_replace(c, r'(\w+) "([^"]*)"', "$1=$2"), ";\\s+", ";"))
