"""Document fingerprints as invertible Bloom lookup tables of paragraph digests.

A text's lines are cut into paragraphs of at most `words` words; each distinct one has a 64-bit
digest. A table has three rows of cells, and a digest is added to one cell of each: cells hold a
count, the sum of digests and the sum of their checks. Two tables of one size subtract cell by cell,
so what both texts have cancels out, and peeling cells of a single digest recovers the digests that
differ. Where peeling gets stuck, both texts are put into tables of twice the size and tried again.

Likeness is the Dice coefficient of the digest sets, from their sizes and the recovered difference.
Null texts are empty; two texts without words have likeness 1. Equal doc_ids stand in order of text,
null doc_ids come first, and the last document's next is the first (itself, if it is alone). Rows of
one doc_id stand in one task. Texts of any length are taken whole; an empty table gives no rows. The
result has the named columns alone; other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.minhash import K1, K2, mix
from locusframe.llm.shared import bounded_batches, cut_points, is_cut, range_of, ranges_for
from locusframe.llm.wordcache import strings

BASE = 8  # cells in each row of a stored fingerprint


def paragraphs(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paragraph digests of each text, one text after the other, and their number."""
    import xxhash

    lists = pc.split_pattern(pc.replace_substring_regex(pa.array(texts, pa.large_string()), r"[ \t\v\f\r]*\n", " \n "), " ")
    found = lists.flatten().dictionary_encode()
    names = strings(found.dictionary)
    of = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in names), np.uint64, len(names))
    code, doc = found.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    end = code == (names.index("\n") if "\n" in names else -1)
    line = np.cumsum(end)
    real = ~end if "" not in names else ~end & (code != names.index(""))
    code, doc, line = code[real], doc[real], line[real]
    at = np.arange(len(code))
    new = np.ones(len(code), bool)
    new[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    place = at - np.maximum.accumulate(np.where(new, at, 0))
    begin = np.flatnonzero(place % words == 0)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    digest = mix(np.add.reduceat(mix(of[code] + (place % words).astype(np.uint64) * K1), begin))
    owner = doc[begin]
    order = np.lexsort((digest, owner))
    digest, owner = digest[order], owner[order]
    keep = np.ones(len(digest), bool)
    keep[1:] = (digest[1:] != digest[:-1]) | (owner[1:] != owner[:-1])
    return digest[keep], np.bincount(owner[keep], minlength=len(texts))


def cells_of(digest: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """Three cell numbers of each digest, in tables of 3 * size cells (a power of two)."""
    salt, m = np.uint64(size * int(K2) & (1 << 64) - 1), np.uint64(size - 1)
    a = mix(digest + salt)
    rows = [a & m, (a >> np.uint64(24)) & m, mix(a) & m] if size <= 1 << 24 else [a & m, mix(a) & m, mix(a + salt) & m]
    return np.stack([table * (3 * size) + r * size + x.astype(np.int64) for r, x in enumerate(rows)])


def check_of(digest: np.ndarray) -> np.ndarray:
    return mix(digest * K1 + K2)


class Tables:
    """Many tables of one size."""

    def __init__(self, n: int, size: int):
        self.n, self.size = n, size
        self.count = np.zeros(n * 3 * size, np.int64)
        self.keys = np.zeros(n * 3 * size, np.uint64)
        self.checks = np.zeros(n * 3 * size, np.uint64)

    def add(self, digest: np.ndarray, table: np.ndarray, sign: np.ndarray) -> None:
        """Adds (sign 1) or takes away (sign -1)."""
        s = sign.astype(np.int64).view(np.uint64)
        for at in cells_of(digest, table, self.size):
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, digest * s)
            np.add.at(self.checks, at, check_of(digest) * s)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Digests on the added side and on the other, counted for each table, and whether the table came out empty."""
        plus, minus = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            s = self.count[look]
            digest = self.keys[look] * s.view(np.uint64)
            pure = (np.abs(s) == 1) & (self.checks[look] * s.view(np.uint64) == check_of(digest))
            digest, s, table = digest[pure], s[pure], look[pure] // (3 * self.size)
            if not len(digest):
                break
            order = np.lexsort((digest, table))
            digest, s, table = digest[order], s[order], table[order]
            once = np.ones(len(digest), bool)
            once[1:] = (digest[1:] != digest[:-1]) | (table[1:] != table[:-1])
            digest, s, table = digest[once], s[once], table[once]
            plus += np.bincount(table[s > 0], minlength=self.n)
            minus += np.bincount(table[s < 0], minlength=self.n)
            self.add(digest, table, -s)
            look = np.unique(cells_of(digest, table, self.size).ravel())
            look = look[np.abs(self.count[look]) == 1]
        empty = ~((self.count != 0) | (self.keys != 0)).reshape(self.n, -1).any(1)
        return plus, minus, empty

    def rendered(self) -> list[str]:
        """Each table's cells in hexadecimal digits: count (2 bytes), digest sum (8), check sum (4)."""
        cell = np.dtype([("count", "<i2"), ("keys", "<u8"), ("checks", "<u4")])
        out = np.zeros(len(self.count), cell)
        out["count"], out["keys"], out["checks"] = self.count, self.keys, self.checks >> np.uint64(32)
        step = 3 * self.size
        return [out[i:i + step].tobytes().hex() for i in range(0, len(out), step)]


def likeness(digest: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of sets left[i] and right[i]: numbers of sets whose digests stand one after the other."""
    begin = np.cumsum(sizes) - sizes
    n, m = sizes[left], sizes[right]
    out, todo, size = np.ones(len(left)), np.flatnonzero(n + m > 0), BASE
    while len(todo):
        failed = []
        for some in np.array_split(todo, -(-int((n[todo] + m[todo] + 3 * size).sum()) // 4_000_000)):
            if not len(some):
                continue
            tables = Tables(len(some), size)
            for side, sign in ((left, 1), (right, -1)):
                k = sizes[side[some]]
                at = np.repeat(begin[side[some]] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
                tables.add(digest[at], np.repeat(np.arange(len(some)), k), np.full(len(at), sign, np.int64))
            plus, minus, whole = tables.peel()
            done = some[whole]
            out[done] = (n[done] - plus[whole] + m[done] - minus[whole]) / (n[done] + m[done])
            failed.append(some[~whole])
        todo, size = np.concatenate(failed), size * 2
    return out


def in_ranges(docs: DataFrame, part_bytes: int = 24_000_000) -> DataFrame:
    """Rows (part, extra, doc_id, text) in order within parts of ascending doc_id; `extra` rows hold the first document of the part behind.

    The number of parts follows the texts' size."""
    rows = bounded_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    low = rows.agg(F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("none"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).head()
    parts = max(2 * ranges_for(docs.sparkSession), -(-low["size"] // part_bytes))
    cuts = cut_points(rows, "doc_id", parts - 1)
    own = rows.withColumn("part", range_of("doc_id", cuts)).withColumn("extra", F.lit(False))
    if cuts and not low["none"]:
        cuts = [c for c in cuts if c != low["low"]]
        own = own.withColumn("part", range_of("doc_id", cuts))
    edge = own.where(is_cut("doc_id", cuts)).withColumn("part", F.col("part") - 1)
    first = own.where(F.col("doc_id").isNull() if low["none"] else F.col("doc_id") == F.lit(low["low"])).withColumn("part", F.lit(len(cuts)))
    both = own.unionByName(edge.unionByName(first).withColumn("extra", F.lit(True)))
    return both.repartition(parts, "part").sortWithinPartitions("part", "extra", "doc_id", "text")


def fingerprints(docs: DataFrame, words: int = 8, part_bytes: int = 24_000_000) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of the characters replaced by the first as many of the next document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        size, part, closed = 0, None, False

        def flush() -> Iterator[pa.RecordBatch]:
            """All held documents but the last, which is the next of the one before it."""
            nonlocal held, size
            if len(held) > 1:
                yield _digest(held, words)
            held = held[-1:]
            size = sum(len(t) for _, t in held)

        for b in batches:
            for p, extra, key, text in zip(b["part"].to_pylist(), b["extra"].to_pylist(), b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                if p != part:
                    yield from flush()
                    held, size, part, closed = [], 0, p, False
                if closed:
                    continue
                held.append((key, text))
                size += len(text)
                if extra:  # the part's last document has its next now
                    closed = True
                    yield from flush()
                    held = []
                elif size > 4_000_000:
                    yield from flush()
        yield from flush()

    return in_ranges(docs, part_bytes).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _digest(held: list[tuple[int | None, str]], words: int) -> pa.RecordBatch:
    texts = [t for _, t in held]
    k = len(texts) - 1
    edited = [t[:len(t) - len(t) // 2] + u[:len(t) // 2] for t, u in zip(texts, texts[1:], strict=False)]
    digest, sizes = paragraphs(texts + edited, words)
    at = np.arange(k)
    near = likeness(digest, sizes, np.concatenate([at, at]), np.concatenate([k + 1 + at, at + 1]))
    tables = Tables(2 * k + 1, BASE)
    tables.add(digest, np.repeat(np.arange(2 * k + 1), sizes), np.ones(len(digest), np.int64))
    prints = tables.rendered()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([d for d, _ in held[:k]], pa.int64()), pa.array([len(t) for t in texts[:k]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(prints[:k], pa.string()), pa.array(prints[k + 1:], pa.string()),
            pa.array(near[:k]), pa.array(near[k:]),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
