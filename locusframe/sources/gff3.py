"""GFF3: lines to features and back, routing by source, gene models by parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusframe.functions import attributes

#: Which evidence type a source pattern stands for, in order of trial.
ROUTES = [
    ("^repeat", "repeat"), ("^blastx:repeatmask$", "repeat"), ("^(est2genome|est_gff|blastn|cdna2genome)", "est"), ("^(tblastx|altest_gff)", "altest"),
    ("^(blastx|protein2genome|protein_gff)", "protein"), ("^(snap|augustus|fgenesh|genemark|pred_gff|evm)", "pred"), ("^(final$|model_gff)", "model"),
]
MODEL_TYPES = ["gene", "mRNA", "exon", "CDS"]


def features(lines: DataFrame, line: str = "value", tag: str | None = None) -> DataFrame:
    """Text lines as seqid, source, type, s, e, score, strand, phase, attributes; comments and blank lines go.

    '.' is null, a strand that is neither + nor - is +, and `tag` stands before the source."""
    text = F.rtrim(F.col(line))
    fields = F.split(text, "\t")
    rows = lines.where(~text.rlike(r"^\s*(#|$)") & (F.size(fields) >= 9))

    # a filter on the result may be evaluated before the lines without nine columns are gone
    f = [F.get(fields, F.lit(i)) for i in range(9)]

    def at(i: int) -> Column:
        return F.nullif(F.trim(f[i]), F.lit("."))

    source = F.concat(F.lit(f"{tag}:"), f[1]) if tag else f[1]
    return rows.select(
        f[0].alias("seqid"), source.alias("source"), f[2].alias("type"), F.least(f[3].try_cast("long"), f[4].try_cast("long")).alias("s"), F.greatest(f[3].try_cast("long"), f[4].try_cast("long")).alias("e"),
        at(5).try_cast("double").alias("score"), F.when(f[6] == "-", -1).otherwise(1).alias("strand"), at(7).try_cast("int").alias("phase"), attributes.parse(f[8]).alias("attributes"),
    )


def read(spark: SparkSession, path: str, tag: str | None = None, seqid: str | None = None) -> DataFrame:
    """A file's or folder's features; a file's part behind ##FASTA has no tabs in nine columns and falls away."""
    lines = spark.read.text(path)
    if seqid is not None:  # before the attributes are parsed
        lines = lines.where(F.col("value").startswith(seqid + "\t"))
    return features(lines, tag=tag)


def by_parent(rows: DataFrame) -> DataFrame:
    """One row per parent ('.' where there is none); contig rows go."""
    parents = F.coalesce(F.try_element_at("attributes", F.lit("Parent")), F.array(F.lit(".")))
    return rows.where("type <> 'contig'").withColumn("parent", F.explode(parents))


def routed(rows: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """Adds evidence_type by source; models keep genes, transcripts, exons and CDS only."""
    kind = None
    for pattern, name in ROUTES:
        test = F.lower("source").rlike(pattern)
        kind = F.when(test, name) if kind is None else kind.when(test, name)
    out = rows.withColumn("evidence_type", kind.otherwise("other")).where((F.col("evidence_type") != "model") | F.col("type").isin(MODEL_TYPES))
    return out.where(F.col("evidence_type").isin(allowed)) if allowed is not None else out


def store(rows: DataFrame, path: str) -> None:
    """The feature store, one folder per evidence type, sorted by contig and start for range reads."""
    rows.repartition("evidence_type", "seqid").sortWithinPartitions("seqid", "s").write.partitionBy("evidence_type").parquet(path)


def models(rows: DataFrame) -> DataFrame:
    """Transcripts with their gene and sorted blocks: gene, transcript, seqid, strand, exons, cds."""
    own = F.try_element_at("attributes", F.lit("ID"))[0]
    parts = by_parent(rows.where(F.col("type").isin("exon", "CDS"))).groupBy("parent").agg(
        F.array_sort(F.collect_set(F.when(F.col("type") == "exon", F.struct("s", "e")))).alias("exons"), F.array_sort(F.collect_set(F.when(F.col("type") == "CDS", F.struct("s", "e")))).alias("cds"),
    )
    transcripts = by_parent(rows.where(F.col("type").isin("mRNA", "transcript"))).select(F.col("parent").alias("gene"), own.alias("transcript"), "seqid", "strand")
    return transcripts.join(parts, transcripts["transcript"] == parts["parent"], "left").drop("parent")


def lines(rows: DataFrame) -> DataFrame:
    """K1, K2: features as text lines."""
    dot = lambda c: F.coalesce(c.cast("string"), F.lit("."))
    strand = F.when(F.col("strand") == 1, "+").when(F.col("strand") == -1, "-").otherwise(".")
    return rows.select(F.concat_ws("\t", "seqid", "source", "type", "s", "e", dot(F.col("score")), strand, dot(F.col("phase")), attributes.render(F.col("attributes"))).alias("value"), "seqid", "s")


def write(rows: DataFrame, path: str) -> None:
    """K9: text files in order of contig and start, each with the version line."""
    out = lines(rows).repartitionByRange("seqid", "s").sortWithinPartitions("seqid", "s").select("value")
    out.write.text(path)


def split_by_contig(rows: DataFrame, path: str) -> None:
    """A folder per contig."""
    lines(rows).select("value", "seqid").repartition("seqid").write.partitionBy("seqid").text(path)


def gene_block(transcripts: DataFrame, exons: DataFrame, coding: DataFrame, source: str = "final") -> DataFrame:
    """K1, K4, K6, K8: genes as text lines: gene, transcripts with their scores, every exon once with all its parents, UTRs, and CDS with phase.

    transcripts: gene, transcript, seqid, strand, aed, eaed, qi. exons: transcript, s, e (disjoint). coding: transcript, cs, ce; a transcript
    without is non-coding and has no CDS or UTR. Returns gene, place (the order of types within a gene), s, e and value."""
    strand = F.when(F.col("strand") > 0, "+").otherwise("-")

    def line(kind, s, e, phase, bag):
        return F.concat_ws("\t", "seqid", F.lit(source), kind, s.cast("string"), e.cast("string"), F.lit("."), strand, phase, bag).alias("value")

    def rows(df: DataFrame, place: int, kind, bag, phase=None):
        return df.select("gene", F.lit(place).alias("place"), "s", "e", line(kind, F.col("s"), F.col("e"), F.lit(".") if phase is None else phase.cast("string"), bag))

    placed = exons.join(transcripts, "transcript")
    span = [F.min("s").alias("s"), F.max("e").alias("e")]
    genes = placed.groupBy("gene", "seqid", "strand").agg(*span)
    whole = placed.groupBy(*transcripts.columns).agg(*span).join(coding, "transcript", "left")
    scores = F.format_string("_AED=%.2f;_eAED=%.2f;_QI=%s", "aed", "eaed", "qi")
    kind = F.when(F.col("cs").isNull(), "ncRNA").otherwise("mRNA")
    shared = placed.groupBy("gene", "seqid", "strand", "s", "e").agg(F.array_join(F.array_sort(F.collect_set(F.col("transcript").cast("string"))), ",").alias("parents"))
    own = placed.join(coding, "transcript")
    order = Window.partitionBy("transcript").orderBy(F.col("s") * F.col("strand")).rowsBetween(Window.unboundedPreceding, -1)
    cds = own.where("s <= ce and cs <= e").withColumns({"s": F.greatest("s", "cs"), "e": F.least("e", "ce")})
    cds = cds.withColumn("phase", F.pmod(-F.coalesce(F.sum(F.col("e") - F.col("s") + 1).over(order), F.lit(0)), F.lit(3)))
    low, high = own.where("s < cs").withColumn("e", F.least("e", F.col("cs") - 1)), own.where("e > ce").withColumn("s", F.greatest("s", F.col("ce") + 1))
    utr = low.withColumn("five", F.col("strand") > 0).union(high.withColumn("five", F.col("strand") < 0))
    of = lambda what: F.concat(F.lit("ID="), "transcript", F.lit(f":{what};Parent="), "transcript")
    parts = [
        rows(genes, 0, F.lit("gene"), F.concat(F.lit("ID="), "gene", F.lit(";Name="), "gene")),
        rows(whole, 1, kind, F.concat(F.lit("ID="), "transcript", F.lit(";Parent="), "gene", F.lit(";Name="), "transcript", F.lit(";"), scores)),
        rows(shared, 2, F.lit("exon"), F.concat(F.lit("ID="), "gene", F.lit(":exon:"), "s", F.lit("-"), "e", F.lit(";Parent="), "parents")),
        rows(utr, 3, F.when(F.col("five"), "five_prime_UTR").otherwise("three_prime_UTR"), F.concat(F.lit("ID="), "transcript", F.lit(":utr;Parent="), "transcript")),
        rows(cds, 4, F.lit("CDS"), of("cds"), F.col("phase")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merged(files: list[DataFrame], models_only: str | None = None, legacy: bool = False) -> DataFrame:
    """Several files' features as one; a top-level ID that an earlier file has goes.

    models_only: keeps rows of this source. legacy: IDs and parents are put behind their file's number, so all stay apart."""
    out = None
    for i, rows in enumerate(files):
        rows = rows.withColumn("file", F.lit(i))
        if legacy:
            renamed = F.transform_values("attributes", lambda k, v: F.when(k.isin("ID", "Parent"), F.transform(v, lambda x: F.concat(F.lit(f"{i}:"), x))).otherwise(v))
            rows = rows.withColumn("attributes", renamed)
        out = rows if out is None else out.unionByName(rows)
    if models_only:
        out = out.where(F.col("source") == models_only)
    if legacy:
        return out
    own = F.try_element_at("attributes", F.lit("ID"))[0]
    top = F.try_element_at("attributes", F.lit("Parent")).isNull() & own.isNotNull()
    first = out.where(top).groupBy(own.alias("_own")).agg(F.min("file").alias("_first"))
    return out.withColumn("_own", F.when(top, own)).join(first, "_own", "left").where(F.col("_first").isNull() | (F.col("_first") == F.col("file"))).drop("_own", "_first")


def embedded_fasta(spark: SparkSession, path: str) -> DataFrame:
    """The sequences behind ##FASTA: seqid, definition, seq.

    A file is cut where a line begins with the mark of a record, so it may be read in splits; the part before the
    first record begins with a comment or a feature line, or holds the marker, and goes."""
    from locusframe.functions.sequences import records

    rows = spark.read.option("lineSep", "\n>").text(path)
    return records(rows.where(~F.col("value").rlike("^#|^[^\n]*(\t[^\n]*){8}") & ~F.contains("value", F.lit("##FASTA")) & (F.trim("value") != "")), "value")


def bed_lines(exons: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Each hit's blocks as a 12-column BED line: seqid, begin from 0, end, name, blocks."""
    block = F.array_sort(F.collect_list(F.struct("s", "e")))
    g = exons.groupBy(*keys).agg(block.alias("b"), F.min("s").alias("low"), F.max("e").alias("high"))
    sizes = F.array_join(F.transform("b", lambda x: (x["e"] - x["s"] + 1).cast("string")), ",")
    starts = F.array_join(F.transform("b", lambda x: (x["s"] - F.col("low")).cast("string")), ",")
    begin = (F.col("low") - 1).cast("string")
    strand = F.when(F.col("strand") > 0, "+").otherwise("-")
    return g.select(F.concat_ws("\t", F.col("seqid").cast("string"), begin, F.col("high").cast("string"), F.col(name).cast("string"), F.lit("0"), strand, begin, F.col("high").cast("string"), F.lit("0"), F.size("b").cast("string"), sizes, starts).alias("value"))


def bed_blocks(lines: DataFrame) -> DataFrame:
    """BED lines as blocks: name, seqid, strand, s, e."""
    f = F.split("value", "\t")
    both = F.arrays_zip(F.split(f[10], ",").alias("n"), F.split(f[11], ",").alias("o"))
    rows = lines.select(f[3].alias("name"), f[0].alias("seqid"), F.when(f[5] == "-", -1).otherwise(1).alias("strand"), f[1].cast("long").alias("b"), F.explode(both).alias("x"))
    s = F.col("b") + 1 + F.col("x.o").cast("long")
    return rows.select("name", "seqid", "strand", s.alias("s"), (s + F.col("x.n").cast("long") - 1).alias("e"))
