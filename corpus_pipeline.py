"""The corpus pipeline: language id, near-dedup, substring dedup, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs. Each operator's own module says
how it treats nulls, ties, empty tables and clashing columns; stages keep the columns of
`documents` and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm import langid, minhash, packing, substrings
from locusframe.llm.shared import shared_dir, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language ID rejects: no letter, or a runner-up that is nearly as likely."""
    return langid.identify(docs.select(COLUMNS)).where(~F.col("rejected")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles, similarity 0.8): the smallest doc_id's.

    Decisions are made and carried out by row, as doc_ids may repeat or be null (a null comes last)."""
    rows = stored(docs.select(COLUMNS).withColumn("_row", F.monotonically_increasing_id()))
    found = minhash.cluster(rows.select(F.col("_row").alias("doc_id"), "text"), words=5, percent=80)
    # a component of one row needs no choice
    many = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    grouped = stored(found.join(many, "component_id").select(F.col("doc_id").alias("_row"), "component_id"))
    named = grouped.join(rows.select("_row", "doc_id"), "_row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row"))["_row"].alias("_row"))
    gone = grouped.select("_row").join(first.select("_row"), "_row", "left_anti")
    return rows.join(gone, "_row", "left_anti").select(COLUMNS)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of 50 words or more that an earlier document has; a document with no word left goes."""
    found = substrings.dedup(docs.select(COLUMNS), window=50)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    left = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return left.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("near_dedup", near_duplicates), ("substring_dedup", substring), ("packing", packed)]

#: SQL can't express compression, min-max hashing at scale or packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = shared_dir(spark)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
