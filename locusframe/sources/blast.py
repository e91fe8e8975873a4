"""Text reports of BLAST searches (nucleotide and translated): a record per query, a row per aligned block."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.operators.intervals import merge

BLOCK = "query string, q_length long, subject string, s_length long, hit int, block int, bits double, score double, evalue double, identical long, positive long, aligned long, gaps long, q_strand int, s_strand int, q_frame int, s_frame int, q_s long, q_e long, s_s long, s_e long"
_LENGTH = re.compile(r"Length\s*=\s*([\d,]+)|\(([\d,]+) letters\)")
_SCORE = re.compile(r"Score\s*=\s*([\d.eE+]+) bits \((\d+)\).*?Expect(?:\(\d+\))?\s*=\s*([\d.eE+-]+)", re.S)
_SHARE = re.compile(r"(Identities|Positives|Gaps)\s*=\s*(\d+)/(\d+)")
_STRAND = re.compile(r"Strand\s*=\s*(Plus|Minus)\s*/\s*(Plus|Minus)")
_FRAME = re.compile(r"Frame\s*=\s*([+-]\d)(?:\s*/\s*([+-]\d))?")
_LINE = re.compile(r"^(Query|Sbjct):?\s+(\d+)\s+\S.*?\s+(\d+)\s*$", re.M)


def _number(text: str) -> float:
    return float("1" + text if text[:1] in "eE" else text)


def _block(text: str, translated: bool) -> dict | None:
    """One aligned block; None where the text has no score or no alignment."""
    score = _SCORE.search(text)
    sides: dict[str, list[int]] = {"Query": [], "Sbjct": []}
    for side, begin, end in _LINE.findall(text):
        sides[side] += [int(begin), int(end)]
    if not score or not sides["Query"] or not sides["Sbjct"]:
        return None
    share = {k: (int(a), int(b)) for k, a, b in _SHARE.findall(text)}
    out = {"bits": float(score[1]), "score": float(score[2]), "evalue": _number(score[3])}
    out |= {"identical": share.get("Identities", (0, 0))[0], "positive": share.get("Positives", share.get("Identities", (0, 0)))[0], "aligned": share.get("Identities", (0, 0))[1], "gaps": share.get("Gaps", (0, 0))[0]}
    way = {"Plus": 1, "Minus": -1}
    strand, frame = _STRAND.search(text), _FRAME.search(text)
    frames = [int(f) if f else None for f in frame.groups()] if frame else [None, None]
    if frame and not translated:  # one frame alone belongs to the subject, unless the query was translated
        frames = [frames[0], frames[1]] if frames[1] is not None else [None, frames[0]]
    out |= {"q_frame": frames[0], "s_frame": frames[1]}
    for k, (side, name) in enumerate((("Query", "q"), ("Sbjct", "s"))):
        at = sides[side]
        drawn = 1 if at[0] <= at[-1] else -1
        told = way[strand[k + 1]] if strand else (1 if frames[k] > 0 else -1) if frames[k] is not None else drawn
        out |= {f"{name}_strand": told, f"{name}_s": min(at), f"{name}_e": max(at)}
    return out


def blocks(record: str | None, translated: bool = True) -> Iterator[dict]:
    """The aligned blocks of one query's record, without its mark; hits count from 1, and blocks within a hit."""
    head, *hits = re.split(r"^>", record or "", flags=re.M)
    name, length = head.split(None, 1)[:1], _LENGTH.search(head)
    for i, hit in enumerate(hits):
        title, _, rest = hit.partition("\n")
        size = _LENGTH.search(hit)
        whole = re.split(r"^(?=\s*Score\s*=)", rest, flags=re.M)
        found = [b for b in (_block(x, translated) for x in whole[1:]) if b]
        for k, b in enumerate(found):
            count = lambda m: int((m[1] or m[2]).replace(",", "")) if m else None
            yield {"query": name[0] if name else "", "q_length": count(length), "subject": title.split()[0] if title.split() else "", "s_length": count(size), "hit": i + 1, "block": k + 1, **b}


def parsed(records: DataFrame, column: str, translated: bool = True) -> DataFrame:
    """Blocks (BLOCK) of records in a text column; a record's text is what follows its `Query=`."""
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    schema = pa.schema([(name, types[kind]) for name, kind in (x.split() for x in BLOCK.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # so many blocks at a time, as a record may have any number of them
        found = (b for batch in batches for r in batch.column(0) for b in blocks(r.as_py(), translated))
        while some := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_pylist(some, schema)

    return records.select(column).mapInArrow(run, BLOCK)


def report(spark: SparkSession, path: str, program: str) -> DataFrame:
    """The blocks of a blastn, blastx or tblastx report; tblastn too.

    Records are cut at `Query=` wherever file splits fall, so that what stands before the first one is no record. Begins and ends are in
    ascending order, the direction is in strand: as told (Strand or Frame), else as drawn. Numbers that are missing are null,
    an expectation without a leading digit has a 1 there. Queries without hits have no rows."""
    records = spark.read.option("lineSep", "Query=").text(path)
    return parsed(records, "value", translated=program in ("blastx", "tblastx")).where(F.col("subject") != "")


def kept(found: DataFrame, least_bits: float, most_evalue: float, least_identity: float, least_share: float) -> DataFrame:
    """Blocks of hits that pass: blocks of more than `least_bits`; a hit's best expectation at most `most_evalue`, its best block's or its own
    identity at least `least_identity`, and its blocks' union over half of `least_share` of the subject."""
    keys = ["query", "hit"]
    strong = found.where(F.col("bits") > least_bits)
    union = merge(strong.select(*keys, F.col("s_s").alias("s"), F.col("s_e").alias("e")), keys).groupBy(*keys).agg(F.sum(F.col("e") - F.col("s") + 1).alias("_bases"))
    best = F.max_by(F.col("identical") / F.col("aligned"), F.struct("score", F.negative("block")))
    hits = strong.groupBy(*keys).agg(F.min("evalue").alias("_evalue"), best.alias("_best"), (F.sum("identical") / F.sum("aligned")).alias("_all"), F.max("s_length").alias("_length"))
    good = hits.join(union, keys).where((F.col("_evalue") <= most_evalue) & (F.greatest("_best", "_all") >= least_identity) & (F.col("_bases") >= least_share / 2 * F.col("_length")))
    return strong.join(good.select(*keys), keys, "left_semi")
