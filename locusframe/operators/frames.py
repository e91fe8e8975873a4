"""Reading frames of long sequences, which are held in chunks; positions count from 1."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.functions.sequences import codon_numbers, residues_by_number, reversed_residues
from locusframe.operators.intervals import overlap_join
from locusframe.shared import stored

#: As many unknown residues in a row make a frame unusable.
UNKNOWN = 10
#: Letters of the next chunk that a chunk repeats, so that every run of unknown residues lies within one.
BEHIND = 3 * UNKNOWN - 1


def chunked(seqs: DataFrame, size: int = 100_000) -> DataFrame:
    """seqid, seq as seqid, chunk (from 0), own (letters of its own) and text, which goes on into the next chunk."""
    n = F.length("seq")
    cut = F.transform(F.sequence(F.lit(0), F.expr(f"(length(seq) - 1) div {size}")), lambda c: F.struct(c.cast("long").alias("chunk"), F.least(n - c * size, F.lit(size)).alias("own"), F.substring("seq", (c * size + 1).cast("int"), F.lit(size + BEHIND)).alias("text")))
    # what is empty goes last, so that a text which is an expression isn't evaluated for the filter too
    return seqs.select("seqid", F.explode(cut).alias("c")).select("seqid", "c.*").where("own > 0")


def _marks(numbers: np.ndarray, own: int, residues: np.ndarray) -> list[np.ndarray]:
    """Places (from 0) below `own` by frame: of stops (three arrays), then of beginning runs of unknown residues (three); numbers are the text's codons'."""
    codons = residues[numbers]
    stops = np.flatnonzero(codons == ord("*"))
    stops = stops[stops < own]
    out = [stops[stops % 3 == f] for f in range(3)]
    strange = codons == ord("X")
    if not strange.any():
        return [*out, *[stops[:0]] * 3]
    for f in range(3):
        unknown = np.cumsum(np.concatenate([[0], strange[f::3]]))
        runs = np.flatnonzero(unknown[UNKNOWN:] - unknown[:-UNKNOWN] == UNKNOWN) * 3 + f
        out.append(runs[runs < own])
    return out


def next_marks(chunks: DataFrame, points: DataFrame, size: int = 100_000, code: str = "universal") -> DataFrame:
    """For distinct points (seqid, strand, b) the next stop and run of unknown residues from b on, wherever they are: stops and
    runs, arrays of three by position modulo 3, null where none follows. On the minus strand codons read backwards; positions
    are always those of the lowest base.

    One row per chunk carries on what lies behind it; a chunk's own marks are searched where its text is."""
    tables = {1: residues_by_number(code), -1: reversed_residues(code)}
    marks = "stops array<long>, runs array<long>"

    def by_position(found: list[int | None], first: int) -> tuple[list[int | None], list[int | None]]:
        """Of frames of a chunk, as arrays by position modulo 3."""
        stops: list[int | None] = [None] * 3
        runs: list[int | None] = [None] * 3
        for f in range(3):
            stops[(first + f) % 3], runs[(first + f) % 3] = found[f], found[3 + f]
        return stops, runs

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for seqid, chunk, own, text in zip(*(b[c].to_pylist() for c in ("seqid", "chunk", "own", "text")), strict=True):
                first, numbers = chunk * size + 1, codon_numbers(text)
                for strand, residues in tables.items():
                    found = [int(x[0]) + first if len(x) else None for x in _marks(numbers, own, residues)]
                    rows.append((seqid, chunk, strand, *by_position(found, first)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = [b.schema.field("seqid").type, pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["seqid", "chunk", "strand", "stops", "runs"])

    kind = chunks.schema["seqid"].dataType.simpleString()
    local = stored(chunks.mapInArrow(firsts, f"seqid {kind}, chunk long, strand int, {marks}"))
    # from the last chunk to the first, so that the window runs on
    behind = Window.partitionBy("seqid", "strand").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    far = lambda c: F.array(*[F.last(F.get(c, F.lit(i)), ignorenulls=True).over(behind) for i in range(3)])
    later = local.select("seqid", "chunk", "strand", far("stops").alias("stops"), far("runs").alias("runs"))
    # at most as many distinct points as a chunk has bases
    asked = points.where("b >= 1").select("seqid", F.expr(f"(b - 1) div {size}").alias("chunk"), "strand", "b").distinct()
    asked = asked.groupBy("seqid", "chunk", "strand").agg(F.collect_list("b").alias("at"))
    work = asked.join(later, ["seqid", "chunk", "strand"]).groupBy("seqid", "chunk").agg(F.collect_list(F.struct("strand", "at", "stops", "runs")).alias("asked")).join(chunks, ["seqid", "chunk"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for seqid, chunk, own, text, wanted in zip(*(b[c].to_pylist() for c in ("seqid", "chunk", "own", "text", "asked")), strict=True):
                first, numbers = chunk * size + 1, codon_numbers(text)
                for w in wanted:
                    here = [x + first for x in _marks(numbers, own, tables[w["strand"]])]
                    at = np.array(w["at"])
                    place = [np.searchsorted(x, at) for x in here]
                    for i, p in enumerate(w["at"]):
                        found = [int(x[k[i]]) if k[i] < len(x) else None for x, k in zip(here, place, strict=True)]
                        stops, runs = by_position(found, first)
                        stops = [s if s is not None else far for s, far in zip(stops, w["stops"], strict=True)]
                        rows.append((seqid, w["strand"], p, stops, [r if r is not None else far for r, far in zip(runs, w["runs"], strict=True)]))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = [b.schema.field("seqid").type, pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["seqid", "strand", "b", "stops", "runs"])

    return work.mapInArrow(find, f"seqid {kind}, strand int, b long, {marks}")


def reads_through(b: Column, e: Column, strand: Column) -> Column:
    """Whether one of three frames has no stop from b to e, and the first such frame no run of unknown residues; columns stops and runs are those of b."""
    test = F.lit(False)
    for f in (2, 1, 0):
        at = F.when(strand > 0, F.pmod(b + f, F.lit(3))).otherwise(F.pmod(e - f - 2, F.lit(3))).cast("int")
        stop, run = F.get("stops", at), F.get("runs", at)
        test = F.when(stop.isNull() | (stop + 2 > e), run.isNull() | (run + BEHIND > e)).otherwise(test)
    return test


def inferred_exons(reads: DataFrame, keys: list[str], chunks: DataFrame, size: int = 100_000, shortest: int = 300) -> DataFrame:
    """A5: exons that spliced reads bound without covering: keys (with seqid and strand), s, e.

    reads: keys, hit, s, e (blocks). From the begin of one spliced read's last block to the end of a later one's first block, where
    the reads lie apart, at least `shortest` bases are between and all of it reads through in one of three frames. A begin's
    exons are given as the longest, which holds the others.

    Of reads with one such begin only the one that ends first matters, and of those with one such end the one that begins last,
    so that pairs are of splice sites, not of reads; and a begin meets only ends before all three frames have stopped."""
    ends = reads.groupBy(*keys, "hit").agg(F.count("*").alias("n"), F.min("s").alias("s0"), F.max("e").alias("e0"), F.max_by("s", "e").alias("b"), F.min_by("e", "s").alias("end")).where("n > 1")
    ends = stored(ends)
    left = ends.groupBy(*keys, "b").agg(F.min("e0").alias("_over"))
    right = ends.groupBy(*keys, "end").agg(F.max("s0").alias("_from"))
    lengths = chunks.groupBy("seqid").agg(F.max(F.col("chunk") * size + F.col("own")).alias("_length"))
    marks = next_marks(chunks, left.select("seqid", "strand", "b"), size)
    known = left.join(marks, ["seqid", "strand", "b"]).join(lengths, "seqid")
    reach = F.greatest(*[F.coalesce(F.get("stops", F.lit(i)) + 1, "_length") for i in range(3)])
    known = known.withColumns({"s": F.col("b") + shortest, "e": F.least(reach, "_length")}).where("s <= e")
    met = overlap_join(known, right.select(*keys, F.col("end").alias("s"), F.col("end").alias("e"), "_from"), keys)
    good = met.where("_from > _over").where(reads_through(F.col("b"), F.col("be"), F.col("strand")))
    return good.groupBy(*keys, "b").agg(F.max("be").alias("e")).select(*keys, F.col("b").alias("s"), "e")


def phased(blocks: DataFrame) -> DataFrame:
    """A protein's blocks (with strand, s, e, gap) as stretches that read in one frame: s, e, and p, where a codon begins.

    gap: operations M (codons), D (codons that the protein lacks), F (bases skipped), R (bases read twice) and I (residues without
    bases), each with a number; without it the block is codons from its first base on. Going back belongs to the codons behind it, on the
    minus strand to those before it. Stretches are cut to the block; a single M is not longer than the block has codons."""
    whole = F.expr("(e - s + 1) div 3")
    gap = F.coalesce(F.nullif("gap", F.lit("")), F.concat(F.lit("M"), whole))
    gap = F.when(gap.rlike(r"^M\d+$"), F.concat(F.lit("M"), F.least(F.regexp_extract(gap, r"(\d+)", 1).cast("long"), whole))).otherwise(gap)
    kinds, sizes = F.regexp_extract_all(gap, F.lit(r"([A-Z])\d+"), 1), F.regexp_extract_all(gap, F.lit(r"[A-Z](\d+)"), 1)
    ops = F.zip_with(kinds, sizes, lambda k, n: F.struct(k.alias("k"), n.cast("long").alias("n")))

    def with_back(o: Column, i: Column) -> Column:
        near = F.get("_ops", F.when(F.col("strand") > 0, i - 1).otherwise(i + 1))
        back = F.when((o["k"] == "M") & (near["k"] == "R"), near["n"]).otherwise(0)
        ahead = F.when(o["k"] == "F", o["n"]).when(o["k"] == "D", 3 * o["n"]).when(o["k"] == "M", 3 * o["n"] - back).otherwise(0)
        return F.struct(o["k"].alias("k"), o["n"].alias("n"), back.alias("back"), ahead.alias("ahead"))

    def step(acc: Column, o: Column) -> Column:
        stretch = F.array(F.struct((acc["at"] - o["back"]).alias("p"), (3 * o["n"]).alias("n")))
        return F.struct((acc["at"] + o["ahead"]).alias("at"), F.when(o["k"] == "M", F.concat(acc["out"], stretch)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.col("s").cast("long").alias("at"), F.array().cast("array<struct<p:bigint,n:bigint>>").alias("out"))
    walked = blocks.withColumn("_ops", ops).withColumn("_ops", F.transform("_ops", with_back)).withColumn("_out", F.explode(F.aggregate("_ops", start, step, lambda a: a["out"])))
    cut = walked.withColumns({"p": F.col("_out.p"), "_s": F.greatest("s", F.col("_out.p")), "_e": F.least(F.col("e"), F.col("_out.p") + F.col("_out.n") - 1)})
    return cut.where("_s <= _e").withColumns({"s": F.col("_s"), "e": F.col("_e")}).drop("_ops", "_out", "_s", "_e")


def joined_by_frame(clusters: DataFrame, chunks: DataFrame, size: int = 100_000, shortest: int = 300) -> DataFrame:
    """C11: clusters of a contig's strand (seqid, strand, s, e; disjoint) with `joined`, the number (from 1) of the run of neighbours whose gaps read through.

    A gap begins behind a cluster and ends three bases before the next one begins, has `shortest` bases at least and lies on the sequence;
    it joins both if one of three frames has no stop in it (see reads_through)."""
    keys = ["seqid", "strand"]
    order = Window.partitionBy(*keys).orderBy("s", "e")
    gaps = stored(clusters.select(*keys, "s", "e", (F.col("e") + 1).alias("b"), (F.lead("s").over(order) - 3).alias("_to")))
    asked = gaps.where(F.col("_to") - F.col("b") + 1 >= shortest)
    lengths = chunks.groupBy("seqid").agg(F.max(F.col("chunk") * size + F.col("own")).alias("_length"))
    known = asked.join(next_marks(chunks, asked.select(*keys, "b"), size), [*keys, "b"]).join(lengths, "seqid").where("_to <= _length")
    through = known.where(reads_through(F.col("b"), F.col("_to"), F.col("strand"))).select(*keys, "s", "e", F.lit(True).alias("_on"))
    marked = gaps.join(through, [*keys, "s", "e"], "left")
    before = F.coalesce(F.lag("_on").over(order), F.lit(False))
    return marked.withColumn("_new", F.when(before, 0).otherwise(1)).select(*keys, "s", "e", F.sum("_new").over(order).alias("joined"))
