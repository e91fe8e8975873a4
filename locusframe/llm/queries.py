"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm import bpe, iblt, langid, licences, minhash, nearest, negatives, packing, prefixes, substrings, tokenstore, topk, warc
from locusframe.llm.shared import stored, table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).withColumn("best_dice", F.round("best_dice", 6))


def op2_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.link(table(spark, sf_dir, "embeddings"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = tokenstore.write_store(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), end_id=2)
    return tokenstore.read_checksums(spark, store)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs.where(~langid.held_out())))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op6_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def op7_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.cluster(table(spark, sf_dir, "documents"), words=2, percent=80)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(prefixes.numbered_turns(table(spark, sf_dir, "conversations")))
    opening = F.crc32(F.col("conv_id").cast("string")) % 9
    return prefixes.trie(prefixes.shared_openings(turns, opening, of=5))


OPERATORS = (
    op1_licence_scan, op2_warc_archives, op3_nn_descent, op4_token_store, op5_language_id, op6_iblt_fingerprints, op7_minmax_near_dedup, op8_best_fit_packing, op9_substring_dedup, op10_byte_bpe,
    op11_exact_top_k, op12_hard_negatives, op13_prefix_trie,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}

SQL: dict[str, str] = {
    "op1_licence_scan": licences.oracle(),
    "op2_warc_archives": """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
        d AS (SELECT page_id, url, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
        SELECT d.page_id, d.payload_bytes, d.payload_digest,
          CASE WHEN f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)""",
    "op3_nn_descent": nearest.SQL,
    "op7_minmax_near_dedup": minhash.SQL,
    "op9_substring_dedup": substrings.SQL,
    "op11_exact_top_k": topk.SQL,
    "op12_hard_negatives": negatives.SQL,
    "op13_prefix_trie": prefixes.SQL,
}
