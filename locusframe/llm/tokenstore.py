"""Content-addressed store of token ids.

Whole texts become id streams that end with `end_id`. A rolling hash over the last ids cuts each
stream into chunks; a chunk is stored once under its digest, however many documents have it. A
document's recipe lists its chunks in order, with the Merkle root over their digests, and recipes
stand in ascending doc_id order with the number of ids before them. The manifest has a row for each recipe file, with
the Merkle root over its documents' roots, places and counts, and the head one row for the manifest. Reading back first recomputes
the manifest from the recipe files and the head from the manifest, so that a file that is lost, added or changed is an error, and then
every digest, root and count from what it reads.

The files (all Parquet, written by Spark in the store's folder):
  chunks/   digest, n, payload (ids, little-endian, `width` bytes each)
  recipes/  doc_id, start, n_tokens, root, chunks (entries of 16 bytes digest and 4 bytes count)
  manifest/ part (file name), n_docs, n_tokens, first_doc, last_doc, start, root
  head/     n_parts, n_docs, n_tokens, root

Null texts are empty and give end_id alone. Equal doc_ids are documents of their own, in order of
root; null doc_ids come first. Texts of any length are encoded whole. An empty table gives empty files.
Columns of docs other than doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.shared import bounded_batches, prefix_sum, ranges_for, shared_dir
from locusframe.llm.wordcache import library_encoder, slices

ENTRY = np.dtype([("digest", "V16"), ("n", "<u4")])
CHUNK, RECIPE = "digest binary, n long, payload binary", "doc_id long, start long, n_tokens long, root binary, chunks binary"


@dataclass(frozen=True)
class Cutter:
    """Where a stream is cut: after an id where the rolling hash over 16 ids ends in zero bits, within least and most."""

    least: int = 64
    bits: int = 8
    most: int = 2048

    def ends(self, ids: np.ndarray, n: np.ndarray) -> Iterator[list[int]]:
        """The chunk ends of each run of n ids, in positions of the whole array."""
        m = np.uint32(0x9E3779B1)
        h = (ids.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        for k in (1, 2, 4, 8):
            h[k:] += h[:-k] * m
            m = np.uint32(int(m) ** 2 & 0xFFFFFFFF)
        at = np.flatnonzero(h >> np.uint32(32 - self.bits) == 0) + 1
        stops = np.cumsum(n)
        i = np.searchsorted(at, stops - n).tolist()
        cuts, k = at.tolist(), len(at)
        for p, begin, stop in zip(i, (stops - n).tolist(), stops.tolist(), strict=True):
            out = []
            while stop - begin > self.least:
                while p < k and cuts[p] < begin + self.least:
                    p += 1
                end = min(cuts[p] if p < k else stop, begin + self.most, stop)
                out.append(end)
                begin = end
            if begin < stop or not out:
                out.append(stop)
            yield out


def digest(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """The root of a binary tree; an odd node goes up as it is."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _staged(docs: DataFrame, tokenizer: str, end_id: int, cutter: Cutter, width: int) -> DataFrame:
    """kind 'chunk': digest, n, payload. kind 'recipe': doc_id, n (ids), digest (root), payload (entries)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = library_encoder(tokenizer, spaced=True), set()
        for b in batches:
            for i, j in slices(b["text"], 8_000_000):
                flat, n = encoder.encode(b["text"].slice(i, j - i))
                ids = np.insert(flat, np.cumsum(n), np.uint32(end_id))
                raw = memoryview(ids.astype("<u2" if width == 2 else "<u4").tobytes())
                kinds, keys, sizes, digests, payloads = [], [], [], [], []
                begin = 0
                for key, size, ends in zip(b["doc_id"].slice(i, j - i).to_pylist(), (n + 1).tolist(), cutter.ends(ids, n + 1), strict=True):
                    entries, leaves = [], []
                    for end in ends:
                        payload = raw[begin * width:end * width]
                        leaves.append(d := digest(payload))
                        entries.append(d + (end - begin).to_bytes(4, "little"))
                        if d not in seen:  # saves writing what this task has written
                            seen.add(d)
                            kinds.append("chunk")
                            keys.append(None)
                            sizes.append(end - begin)
                            digests.append(d)
                            payloads.append(bytes(payload))
                        begin = end
                    kinds.append("recipe")
                    keys.append(key)
                    sizes.append(size)
                    digests.append(merkle(leaves))
                    payloads.append(b"".join(entries))
                if len(seen) > 500_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(payloads, pa.binary())], ["kind", "doc_id", "n", "digest", "payload"])

    return bounded_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, "kind string, doc_id long, n long, digest binary, payload binary")


def write_store(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, cutter: Cutter = Cutter(), width: int = 2) -> str:
    """Writes the store's files and returns its folder. width 2 holds ids below 65,536."""
    spark = docs.sparkSession
    path = path or shared_dir(spark)
    staging = shared_dir(spark)
    _staged(docs, tokenizer, end_id, cutter, width).write.partitionBy("kind").option("compression", "zstd").parquet(staging)
    staged = spark.read.schema("doc_id long, n long, digest binary, payload binary, kind string").parquet(staging)
    chunks = staged.where("kind = 'chunk'").select("digest", "n", "payload").dropDuplicates(["digest"])
    chunks.write.option("compression", "zstd").parquet(f"{path}/chunks")
    recipes = staged.where("kind = 'recipe'").select("doc_id", F.col("n").alias("n_tokens"), F.col("digest").alias("root"), F.col("payload").alias("chunks"), F.monotonically_increasing_id().alias("row"))
    ordered = prefix_sum(recipes, ["doc_id", "root", "row"], "n_tokens", "start").drop("row")
    ordered = ordered.repartitionByRange(ranges_for(spark), "doc_id", "start").sortWithinPartitions("doc_id", "start")
    ordered.select("doc_id", "start", "n_tokens", "root", "chunks").write.option("compression", "zstd").parquet(f"{path}/recipes")

    manifest = _manifest(spark, path)
    manifest.write.parquet(f"{path}/manifest")
    _head(spark.read.schema(manifest.schema).parquet(f"{path}/manifest")).write.parquet(f"{path}/head")
    return path


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """What the recipe files hold now, a row per file."""

    def seal(t: pa.Table) -> pa.Table:
        t = t.sort_by("start")
        leaves = [r + int(s).to_bytes(8, "little") + int(n).to_bytes(8, "little") for r, s, n in zip(*(t[c].to_pylist() for c in ("root", "start", "n_tokens")), strict=True)]
        first, last = t["doc_id"][0].as_py(), t["doc_id"][-1].as_py()
        cols = [t["part"].slice(0, 1), *(pa.array([x], pa.int64()) for x in (t.num_rows, sum(t["n_tokens"].to_pylist()), first, last, t["start"][0].as_py())), pa.array([merkle(leaves)], pa.binary())]
        return pa.table(cols, names=["part", "n_docs", "n_tokens", "first_doc", "last_doc", "start", "root"])

    rows = spark.read.schema(RECIPE).parquet(f"{path}/recipes")
    rows = rows.select(F.col("_metadata.file_name").alias("part"), "doc_id", "start", "n_tokens", "root")
    return rows.groupBy("part").applyInArrow(seal, "part string, n_docs long, n_tokens long, first_doc long, last_doc long, start long, root binary")


def _head(manifest: DataFrame) -> DataFrame:
    """One row for all files, of which there are as many as partitions."""
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "part", F.hex("root").alias("root")))), lambda x: x["root"]), ",")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return manifest.agg(F.count("*").alias("n_parts"), total("n_docs"), total("n_tokens"), F.sha2(parts, 256).alias("root"))


def verify(spark: SparkSession, path: str) -> None:
    """Holds the recipe files against the manifest, and the manifest against the head."""
    now = _manifest(spark, path)
    manifest = spark.read.schema(now.schema).parquet(f"{path}/manifest")
    head = _head(manifest)
    if head.collect() != spark.read.schema(head.schema).parquet(f"{path}/head").collect():
        raise ValueError("the manifest isn't the one that the store was sealed with")
    row = F.struct(*now.columns)
    both = now.select("part", row.alias("now")).join(manifest.select("part", row.alias("then")), "part", "full")
    bad = both.where(~F.col("now").eqNullSafe(F.col("then"))).head(1)
    if bad:
        raise ValueError(f"recipe file {bad[0]['part']} isn't the one in the manifest")


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    """A row per chunk of each document: start, doc_id, n_tokens, seq, digest, n, after (ids behind it). Roots and counts are checked."""
    verify(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blobs = b["chunks"].to_pylist()
            entries = np.frombuffer(b"".join(blobs), ENTRY)
            count = np.fromiter((len(x) // 20 for x in blobs), np.int64, len(blobs))
            ends, n = np.cumsum(count), entries["n"].astype(np.int64)
            leaves = [x.tobytes() for x in entries["digest"]]
            for k, e, root in zip(count.tolist(), ends.tolist(), b["root"].to_pylist(), strict=True):
                if merkle(leaves[e - k:e]) != root:
                    raise ValueError("a recipe doesn't match its Merkle root")
            if len(blobs) and (np.add.reduceat(n, ends - count) != b["n_tokens"].to_numpy()).any():
                raise ValueError("a recipe's chunks don't add up to its count")
            row, upto = np.repeat(np.arange(len(blobs)), count), np.cumsum(n)
            after = (upto[ends - 1] if len(blobs) else upto)[row] - upto
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([b["doc_id"].take(take), b["start"].take(take), b["n_tokens"].take(take), pa.array(np.arange(len(row)) - np.repeat(ends - count, count), pa.int32()), pa.array(leaves, pa.binary()), pa.array(n), pa.array(after)], ["doc_id", "start", "n_tokens", "seq", "digest", "n", "after"])

    return spark.read.schema(RECIPE).parquet(f"{path}/recipes").mapInArrow(run, "doc_id long, start long, n_tokens long, seq int, digest binary, n long, after long")


def read_ids(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """Whole documents from the files: doc_id, start, n_tokens, ids (binary, `width` bytes each)."""
    chunks = spark.read.schema(CHUNK).parquet(f"{path}/chunks").select("digest", "payload")
    return (
        read_recipes(spark, path).join(chunks, "digest").groupBy("doc_id", "start", "n_tokens")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "payload"))).alias("parts"))
        .select("doc_id", "start", "n_tokens", F.expr("aggregate(parts, cast('' as binary), (a, x) -> a || x.payload)").alias("ids"))
    )


def _power(n: np.ndarray) -> np.ndarray:
    """x^(8n) in the field of zlib's CRC-32, for an array of byte counts."""
    square, out = np.uint32(0x00800000), np.full(len(n), 0x80000000, np.uint32)  # x^8 and 1
    for k in range(int(n.max(initial=0)).bit_length()):
        out = np.where(n >> k & 1, _times(out, np.full(1, square)), out)
        square = _times(np.full(1, square), np.full(1, square))[0]
    return out


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = np.broadcast_arrays(a, b)
    b, out = b.astype(np.uint32), np.zeros(a.shape, np.uint32)
    for k in range(31, -1, -1):
        out ^= np.where(a >> np.uint32(k) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return out


def crc_before(crc: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What a part's CRC-32 adds (by exclusive or) to the whole's when so many bytes follow the part."""
    each, which = np.unique(after, return_inverse=True)
    return _times(_power(each)[which], crc.astype(np.uint32))


def read_checksums(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of all ids as little-endian 32-bit integers).

    Each stored chunk is read once and checked against its digest; a document's checksum is put
    together from its chunks'. A missing chunk or recipe, or a count that differs, is an error."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crcs, counts = [], []
            for d, payload in zip(b["digest"].to_pylist(), b["payload"].to_pylist(), strict=True):
                if digest(payload) != d:
                    raise ValueError("a chunk doesn't match its digest")
                crcs.append(zlib.crc32(np.frombuffer(payload, "<u2" if width == 2 else "<u4").astype("<u4")))
                counts.append(len(payload) // width)
            yield pa.RecordBatch.from_arrays([b["digest"], pa.array(crcs, pa.int64()), pa.array(counts, pa.int64())], ["digest", "crc", "stored"])

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b["crc"].null_count or b["stored"] != b["n"]:
                raise ValueError("a recipe names a chunk that the store doesn't have")
            crc = crc_before(b["crc"].to_numpy(), b["after"].to_numpy() * 4).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["start"], b["n_tokens"], b["n"], pa.array(crc)], ["doc_id", "start", "n_tokens", "n", "crc"])

    chunks = spark.read.schema(CHUNK).parquet(f"{path}/chunks").select("digest", "payload").mapInArrow(sums, "digest binary, crc long, stored long")
    parts = read_recipes(spark, path).join(chunks, "digest", "left").select("doc_id", "start", "n_tokens", "n", "after", "crc", "stored")
    shifted = parts.mapInArrow(shift, "doc_id long, start long, n_tokens long, n long, crc long")
    whole = shifted.groupBy("doc_id", "start").agg(F.sum("n").alias("n_tokens"), F.expr("bit_xor(crc)").alias("ids_crc32"))
    return whole.select("doc_id", "start", "n_tokens", "ids_crc32")
