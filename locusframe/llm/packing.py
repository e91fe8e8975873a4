"""Bounded-space online best-fit packing of token pieces into sequences.

Documents are tokenized once into a table of pieces (lengths and checksums, no ids). Pieces are
dealt to tasks by a hash of their key. Each task packs its pieces as they come: the fullest open
bin with room takes a piece (a bitset over free space finds it), a new bin is opened where none
has room, and at most `open_bins` stay open, the fullest closing first. The bins that are open
at a task's end go on, as whole bundles, to a next round of fewer tasks, until one task is left;
what a task of a later round holds is bounded by fan_in * open_bins bundles.

Null texts are empty and give the end id alone. Texts of any length are encoded whole and cut into
pieces of the capacity. Equal or null doc_ids are packed as separate rows; bins with equal room are
taken in the order last opened first, so ties depend on a hash of the piece alone. An empty table gives
no rows. The result has the named columns alone; other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.shared import bounded_batches, ranges_for, stored
from locusframe.llm.wordcache import library_encoder, slices


class OpenBins:
    """Open bins keyed by free space. `bits` has a bit for each free space that some open bin has."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.count = 0

    def _push(self, free: int, bin_: int) -> None:
        self.at[free].append(bin_)
        self.bits |= 1 << free

    def _pop(self, free: int) -> int:
        bin_ = self.at[free].pop()
        if not self.at[free]:
            self.bits &= ~(1 << free)
        return bin_

    def add(self, size: int, new: int) -> tuple[int, int]:
        """The bin that takes the piece and the offset there; `new` is the number of a bin if one is opened."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_ = self._pop(free)
            self.count -= 1
        else:
            free, bin_ = self.capacity, new
        if free > size:
            if self.count == self.most:  # the fullest has the least free space
                self._pop((self.bits & -self.bits).bit_length() - 1)
                self.count -= 1
            self._push(free - size, bin_)
            self.count += 1
        return bin_, self.capacity - free

    def left(self) -> list[tuple[int, int]]:
        """(bin, used) of the bins that are still open."""
        return [(b, self.capacity - free) for free, bins in enumerate(self.at) for b in bins]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """A row per piece: rid (of the row of docs), doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, spaced=False)
        for b in batches:
            rid, doc_id = b["rid"].to_numpy(), b["doc_id"]
            for i, j in slices(b["text"]):
                flat, n = encoder.encode(b["text"].slice(i, j - i))
                count = (n + capacity) // capacity  # of n + 1 ids
                row = np.repeat(np.arange(j - i), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(n[row] + 1 - start, capacity)
                first = (np.cumsum(n) - n)[row] + start
                last = piece == count[row] - 1
                end = np.array([end_id], np.uint32).tobytes()
                crc = [zlib.crc32(end, zlib.crc32(flat[a:a + m - 1])) if z else zlib.crc32(flat[a:a + m]) for a, m, z in zip(first.tolist(), length.tolist(), last.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(rid[i:j][row]), doc_id.slice(i, j - i).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["rid", "doc_id", "piece", "start", "length", "ids_crc32"])

    rows = bounded_batches(docs).select(F.monotonically_increasing_id().alias("rid"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "rid long, doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(items: DataFrame, capacity: int = 2048, open_bins: int = 512, per_task: int = 100_000, fan_in: int = 16) -> DataFrame:
    """items: item (unique long), length (1 to capacity). Returns item, sequence_id, offset.

    per_task: items of a task in the first round, about."""
    spark = items.sparkSession
    whole, rest = items.where(F.col("length") >= capacity), items.where(F.col("length") < capacity)
    n = rest.agg(F.count("*")).head()[0]
    tasks = max(1, -(-n // per_task))
    # full pieces are sequences of their own; their numbers are even and those of shared bins odd
    done = [whole.select("item", (F.col("item") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    bundles = rest.select(F.col("item").alias("bundle"), "length")
    links = []  # (bundle, into, at) of each round: bundles go into the bundle of their bin
    while True:
        rounds = len(links)
        dealt = bundles.withColumn("task", F.pmod(F.xxhash64("bundle", F.lit(rounds)), F.lit(tasks)).cast("int"))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins, task = None, None
            for b in batches:
                into, at, of, sizes, keys = [], [], b["task"].to_pylist(), b["length"].to_pylist(), b["bundle"].to_pylist()
                for t, key, size in zip(of, keys, sizes, strict=True):
                    if t != task:
                        bins, task = OpenBins(capacity, open_bins), t
                    x, y = bins.add(size, key)
                    into.append(x)
                    at.append(y)
                yield pa.RecordBatch.from_arrays([b["task"], b["bundle"], b["length"], pa.array(into, pa.int64()), pa.array(at, pa.int64())], ["task", "bundle", "length", "into", "at"])

        placed = stored(dealt.repartition(min(tasks, 4 * ranges_for(spark)), "task").sortWithinPartitions("task", F.xxhash64("bundle"), "bundle").mapInArrow(pack, "task int, bundle long, length long, into long, at long"))
        links.append(placed.select("bundle", "into", "at"))
        if tasks == 1:
            break
        # the fullest close first, so the open_bins emptiest bins of a task can take more
        used = placed.groupBy("task", "into").agg(F.sum("length").alias("length")).where(F.col("length") < capacity)
        emptiest = Window.partitionBy("task").orderBy("length", "into")
        bundles = used.withColumn("rank", F.row_number().over(emptiest)).where(F.col("rank") <= open_bins).select(F.col("into").alias("bundle"), "length")
        tasks = -(-tasks // fan_in)
    at = links[0].select(F.col("bundle").alias("item"), F.col("into").alias("bin"), F.col("at").alias("offset"))
    for link in links[1:]:
        at = at.join(link.select(F.col("bundle").alias("bin"), "into", "at"), "bin", "left").select("item", F.coalesce("into", "bin").alias("bin"), (F.col("offset") + F.coalesce("at", F.lit(0))).alias("offset"))
    done.append(at.select("item", (F.col("bin") * 2 + 1).alias("sequence_id"), "offset"))
    return done[0].unionByName(done[1])


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, open_bins: int = 512) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, tokenizer, capacity, end_id).withColumn("item", F.monotonically_increasing_id()).drop("rid")
    cut = stored(cut)
    return cut.join(best_fit(cut.select("item", "length"), capacity, open_bins), "item").drop("item")
