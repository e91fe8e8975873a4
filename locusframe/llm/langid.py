"""Language identification by compression.

Each language's dictionary is raw text of that language, in lower case and without marks. A text so cleaned is compressed by Zstandard with
every dictionary in turn; the language whose dictionary gives the fewest bytes is chosen, and the
choice is rejected when the runner-up is nearly as small. A dictionary saves a nearly fixed number of
bytes, so texts are compressed in blocks of `BLOCK` bytes, each from the dictionary alone, and sizes
are summed: the margin doesn't shrink with a text's length.

Fitting takes, for each language, the `docs_per_lang` labelled documents with the smallest hash of
their id among those of at most `longest_bytes` of text: a bounded number of rows, whole texts, which
doesn't grow with the corpus. Prediction reads whole texts and nothing else.

Null texts and texts without a letter are `und` with score 0. Ties go to the first language in
alphabetical order. With one learned language every text with a letter gets it, with score 1;
with none, every text is `und`. Rows with equal or null keys are predicted one by one; equal rows are
learned once, rows without a doc_id never. Texts of any length are compressed whole, block by block. An
empty table gives no rows. Columns of docs named lang_pred, score, margin, rejected or _text are
replaced by the results; others, whatever their names, stay.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.shared import bounded_batches

#: Bytes of a text that are compressed at once.
BLOCK = 16_384


def fit(labelled: DataFrame, docs_per_lang: int = 64, longest_bytes: int = 20_000, level: int = 6) -> dict[str, bytes]:
    """Raw dictionaries by language, from doc_id, text and lang.

    At most docs_per_lang rows of a language, of at most longest_bytes each, come to the driver. A sampled
    text goes into its language's dictionary only if dictionaries of the sample's other half give it the
    same language, so that wrong labels don't spread."""
    size = F.octet_length("text")
    rows = labelled.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (size > 0) & (size <= longest_bytes)).select("doc_id", "lang", "text").withColumn("_hash", F.xxhash64("text"))
    key = ["doc_id", "lang", "_hash"]
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "_hash")
    ids = rows.select(key).distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= docs_per_lang)
    # docs_per_lang keys a language are few enough to send to every task; repeated rows are one again before they leave
    sample = rows.join(F.broadcast(ids), key).dropDuplicates(key).select("lang", "rank", "text").collect()
    halves: list[dict[str, dict[str, None]]] = [{}, {}]
    sample.sort(key=lambda r: (r["lang"], r["rank"]))
    for r, text in zip(sample, letters(pa.array([r["text"] for r in sample], pa.string())).to_pylist(), strict=True):
        halves[zlib.crc32(text.encode()) % 2].setdefault(r["lang"], {})[text] = None

    def joined(texts) -> bytes:
        return "\n".join(texts).encode()

    def raw(half: dict) -> dict[str, bytes]:
        return {k: v for k, x in sorted(half.items()) if len(v := joined(x)) >= 8}

    kept: dict[str, list[str]] = {}
    for k in (0, 1):
        makers = compressors(raw(halves[1 - k]), level)
        for lang, texts in sorted(halves[k].items()):
            for t in texts:
                sizes = {x: len(f(t.encode())) for x, f in makers.items()}
                if lang not in sizes or sizes[lang] == min(sizes.values()):
                    kept.setdefault(lang, []).append(t)
    return raw(kept)


def letters(texts: pa.Array) -> pa.Array:
    """Lower-case letters, with one space for whatever stands between runs of them."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"\PL+", " ")


def compressors(dictionaries: dict[str, bytes], level: int) -> dict[str, Callable[[bytes], bytes]]:
    import zstandard

    out = {}
    for lang in sorted(dictionaries):
        d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out[lang] = zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_checksum=False).compress
    return out


def packed_size(compress: Callable[[bytes], bytes], text: bytes) -> int:
    """Bytes of a text's blocks, each compressed alone."""
    return sum(len(compress(text[i:i + BLOCK])) for i in range(0, len(text), BLOCK))


def predict(docs: DataFrame, dictionaries: dict[str, bytes], level: int = 6, least_margin: float = 0.01) -> DataFrame:
    """Adds lang_pred, score (0 to 1), margin (bytes saved against the runner-up, as a share) and rejected."""
    spark = bounded_batches(docs).sparkSession
    sent = spark.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        makers = compressors(sent.value, level)
        langs, makers = list(makers), list(makers.values())
        for b in batches:
            found = []
            for text in letters(b["_text"].cast(pa.large_string())).cast(pa.large_binary()).to_pylist():
                if text is None or not langs:
                    found.append(("und", 0.0, 0.0))
                    continue
                sizes = [packed_size(f, text) for f in makers]
                best = min(range(len(sizes)), key=sizes.__getitem__)
                rest = sizes[:best] + sizes[best + 1:]
                if not rest:
                    found.append((langs[best], 1.0, 1.0))
                    continue
                saved = min(rest) - sizes[best]
                found.append((langs[best], 1 / (1 + math.exp(-min(saved, 600) / 4)), saved / min(rest)))
            cols = {n: c for n, c in zip(b.schema.names, b.columns, strict=True) if n != "_text"}
            cols |= {"lang_pred": pa.array([x[0] for x in found], pa.string()), "score": pa.array([x[1] for x in found], pa.float64()), "margin": pa.array([x[2] for x in found], pa.float64())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    kept = docs.drop("lang_pred", "score", "margin", "rejected", "_text")
    text = F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("string"))
    schema = kept.schema.add("lang_pred", "string").add("score", "double").add("margin", "double")
    out = kept.withColumn("_text", text).mapInArrow(run, schema)
    return out.withColumn("rejected", (F.col("lang_pred") == "und") | (F.col("margin") < least_margin))


def held_out(doc_id: str = "doc_id"):
    """Documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, **options) -> DataFrame:
    """Learns from the documents that are not held out and predicts all of them."""
    return predict(docs, fit(docs.where(~held_out())), **options)
