"""FASTA: records read by their own separator, and written wrapped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.functions.sequences import records, wrapped


def read(spark: SparkSession, path: str) -> DataFrame:
    """Seqid, definition, seq. Carriage returns, blanks and line ends within sequences go."""
    text = F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "^>", "")
    rows = spark.read.option("lineSep", "\n>").text(path).select(text.alias("t")).where(F.trim("t") != "")
    return records(rows, "t")


def count(spark: SparkSession, path: str) -> int:
    """S3: the number of records, from lines that begin with the mark."""
    return spark.read.text(path).where(F.col("value").startswith(">")).count()


def ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids and definitions alone."""
    return read(spark, path).select("seqid", "definition")


def lookup(seqs: DataFrame, wanted: DataFrame, priority: str | None = None) -> DataFrame:
    """The records of wanted ids (column seqid); of several, the one of least `priority`."""
    rows = seqs.join(wanted.select("seqid").distinct(), "seqid", "left_semi")
    if priority is None:
        return rows
    return rows.groupBy("seqid").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "seqid"]), priority).alias("r")).select("seqid", "r.*")


def text(seqs: DataFrame, width: int = 60) -> DataFrame:
    """One text value per record."""
    head = F.concat(F.lit(">"), F.col("seqid").cast("string"), F.when(F.coalesce("definition", F.lit("")) != "", F.concat(F.lit(" "), "definition")).otherwise(""))
    return seqs.select(F.concat(head, F.lit("\n"), wrapped(F.col("seq"), width)).alias("value"))


def transcript_headers(rows: DataFrame) -> DataFrame:
    """Definitions of transcripts from name, t_offset, aed, eaed and qi."""
    return rows.withColumn("definition", F.format_string("transcript offset:%d AED:%.2f eAED:%.2f QI:%s", "t_offset", "aed", "eaed", "qi"))


def renamed(seqs: DataFrame, names: DataFrame) -> DataFrame:
    """Seqid and definition replaced as a whole by names (seqid, new) where mapped; others stay."""
    both = seqs.join(names, "seqid", "left")
    return both.withColumns({"seqid": F.coalesce("new", F.col("seqid").cast("string")), "definition": F.when(F.col("new").isNull(), F.col("definition"))}).drop("new")


def merged(spark: SparkSession, path: str, pattern: str = r"([^/]+?)\.(transcripts|proteins|non_overlapping|noncoding)\.fasta$") -> DataFrame:
    """Records of many files with the group that their file's name tells (column kind)."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "^>", "").alias("t"), F.regexp_extract(F.input_file_name(), pattern, 2).alias("kind"))
    found = rows.where(F.trim("t") != "")
    head = F.regexp_extract("t", r"^([^\n]*)", 1)
    return found.select("kind", F.regexp_extract(head, r"^(\S+)", 1).alias("seqid"), F.regexp_replace(F.regexp_replace("t", r"^[^\n]*\n?", ""), r"\s+", "").alias("seq"))
