"""Start and stop codons of transcripts, sought beyond their ends in the contig."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.sequences import codon_table, reverse_complement
from locusframe.shared import stored

#: More unknown codons than this in a row, beyond the transcript, end a walk.
UNKNOWN = 5
#: Bases by which a walk beyond the transcript's begin is counted on.
STRIDE = 100
STATE = "tx long, strand int, seqid long, side string, status string, walked long, carry string, repeats int, pos long, way int, guard long, offset long, room long"


def _walk(texts: Iterator[pd.DataFrame], stops: set[str], starts: set[str], known: set[str]) -> Iterator[pd.DataFrame]:
    """Goes on from each row's state through its text, letters in walking order; a row whose text is null has reached the contig's end."""
    columns = [c.split()[0] for c in STATE.split(", ")]
    for pdf in texts:
        out = []
        for row in pdf.itertuples(index=False):
            x = row._asdict()
            if x["text"] is None or x["text"] != x["text"]:
                x["status"] = "none"
            letters = x["carry"] + (x["text"] or "" if x["status"] == "open" else "")
            at = 0
            while x["status"] == "open" and at + 3 <= len(letters):
                codon = letters[at:at + 3].upper()
                codon = codon if x["side"] == "stop" else codon[::-1]
                at += 3
                x["walked"] += 3
                unknown = codon not in known
                x["repeats"] = x["repeats"] + 1 if unknown else 0
                beyond = x["walked"] - x["offset"]
                reach = min(-(-beyond // STRIDE) * STRIDE, x["room"])
                blocked = x["repeats"] > UNKNOWN and (x["walked"] >= x["guard"] if x["side"] == "stop" else beyond > 0 and reach > x["offset"])
                if x["side"] == "stop":
                    x["status"] = "none" if blocked else "found" if codon in stops else "open"
                else:
                    x["status"] = "none" if codon in stops else "found" if codon in starts else "none" if blocked else "open"
            x["carry"] = letters[at:] if x["status"] == "open" else ""
            out.append([x[c] for c in columns])
        yield pd.DataFrame(out, columns=columns)


def walks(transcripts: DataFrame, chunks: DataFrame, size: int, code: str = "universal", window: int = 3000) -> DataFrame:
    """P11's walks: from a coding span's end to the first stop codon behind it, and from its begin back to a start codon before the next stop.

    transcripts: tx, seqid, strand, s, e (span on the contig), seq (the spliced transcript, in its own direction), offset (bases before the coding span), end
    (the place behind it, from 1). chunks: frames.chunked. A walk first goes through the rest of the transcript, then over the contig,
    base by base as it lies, from chunk to chunk: a round looks up the chunk at each walk's place, and the last codon's
    bases are carried over. It ends at what it seeks, at the contig's end, or in more than five unknown codons. Rounds are written and
    stop when no walk is open. Returns tx, strand, side (stop, start), status (found, none) and walked (bases)."""
    table = codon_table(code)
    stops, starts = {c for c, a in table.items() if a == "*"}, {"ATG"}
    lengths = chunks.groupBy("seqid").agg(F.max(F.col("chunk") * size + F.col("own")).alias("_length"))
    schema = STATE
    plus = F.col("strand") > 0
    rows = transcripts.join(lengths, "seqid")

    def begun(side: str, text: Column, pos: Column, way: Column, room: Column) -> DataFrame:
        guard = F.length("seq") - F.col("end")
        return rows.select("tx", F.col("strand").cast("int"), "seqid", F.lit(side).alias("side"), F.lit("open").alias("status"), F.lit(0).cast("long").alias("walked"), F.lit("").alias("carry"), F.lit(0).alias("repeats"), pos.cast("long").alias("pos"), way.cast("int").alias("way"), guard.cast("long").alias("guard"), F.col("offset").cast("long").alias("offset"), room.cast("long").alias("room"), text.alias("text"))

    ahead = begun("stop", F.expr("substring(seq, cast(end as int))"), F.when(plus, F.col("e") + 1).otherwise(F.col("s") - 1), F.when(plus, 1).otherwise(-1), F.when(plus, F.col("_length") - F.col("e")).otherwise(F.col("s") - 1))
    back = begun("start", F.reverse(F.expr("left(seq, cast(offset as int))")), F.when(plus, F.col("s") - 1).otherwise(F.col("e") + 1), F.when(plus, -1).otherwise(1), F.when(plus, F.col("s") - 1).otherwise(F.col("_length") - F.col("e")))

    def go(df: DataFrame) -> DataFrame:
        return stored(df.mapInPandas(lambda b: _walk(b, stops, starts, set(table)), schema))

    state, width = go(ahead.union(back)), window
    while not state.where("status = 'open'").isEmpty():
        open_ = state.where("status = 'open'").withColumn("chunk", F.expr(f"floor((pos - 1) / {size})"))
        held = open_.join(chunks.select("seqid", "chunk", "own", "text"), ["seqid", "chunk"], "left")
        place = F.col("pos") - F.col("chunk") * size
        n = F.when(F.col("way") > 0, F.least(F.lit(width), F.col("own") - place + 1)).otherwise(F.least(F.lit(width), place)).cast("int")
        first = F.when(F.col("way") > 0, place).otherwise(place - n + 1).cast("int")
        piece = F.when((place >= 1) & (place <= F.col("own")), F.substring("text", first, n))
        forward = F.when(F.col("strand") > 0, piece).otherwise(F.reverse(reverse_complement(piece)))
        text = F.when(F.col("way") > 0, forward).otherwise(F.reverse(forward))
        on = held.withColumn("_text", text).withColumn("pos", F.when(F.col("_text").isNull(), F.col("pos")).otherwise(F.col("pos") + F.col("way") * F.length("_text")))
        names = [c.split()[0] for c in STATE.split(", ")]
        state, width = stored(state.where("status <> 'open'").union(go(on.select(*names, F.col("_text").alias("text"))))), size
    return state.select("tx", "strand", "side", "status", "walked")


def adjusted(transcripts: DataFrame, chunks: DataFrame, size: int, code: str = "universal") -> DataFrame:
    """Transcripts whose coding span has been walked out to a stop and a start codon, where they lack them.

    Where the codon before `end` is no stop, the span grows to the first one in frame; where the codon at `offset` is no start, it grows back
    to a start codon, or else shrinks to the first one inside that comes before a stop. Ends beyond the transcript move its span. Returns tx, seqid,
    strand, s, e, offset and end (in the new transcript), has_start and has_stop."""
    table = codon_table(code)
    stops = [c for c, a in table.items() if a == "*"]
    at = lambda p: F.upper(F.substring("seq", p.cast("int"), F.lit(3)))
    had = transcripts.withColumns({"_stop": at(F.col("end") - 3).isin(stops), "_start": at(F.col("offset") + 1) == "ATG"})
    found = walks(had, chunks, size, code).where("status = 'found'").groupBy("tx", "strand").pivot("side", ["stop", "start"]).agg(F.first("walked")).withColumnsRenamed({"stop": "_ahead", "start": "_back"})
    # the first start inside that no stop comes before
    codons = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.expr("(length(seq) - offset) div 3 - 1"))), lambda k: F.struct(k.alias("k"), at(F.col("offset") + 3 * k + 1).alias("c")))
    inside = F.get(F.filter(codons, lambda x: x["c"].isin("ATG", *stops)), F.lit(0))
    rows = had.join(found, ["tx", "strand"], "left").withColumn("_in", F.when((F.length("seq") - F.col("offset") >= 6) & (inside["c"] == "ATG"), 3 * inside["k"]))
    end = F.when(F.col("_stop") | F.col("_ahead").isNull(), F.col("end")).otherwise(F.col("end") + F.col("_ahead"))
    offset = F.when(F.col("_start"), F.col("offset")).otherwise(F.coalesce(F.col("offset") - F.col("_back"), F.col("offset") + F.col("_in"), F.col("offset")))
    more = F.greatest(F.lit(0), end - 1 - F.length("seq"))
    before = F.greatest(F.lit(0), -offset)
    plus = F.col("strand") > 0
    return rows.select(
        "tx", "seqid", "strand", (F.col("s") - F.when(plus, before).otherwise(more)).alias("s"), (F.col("e") + F.when(plus, more).otherwise(before)).alias("e"), (offset + before).cast("long").alias("offset"), (end + before).cast("long").alias("end"),
        (F.col("_start") | F.col("_back").isNotNull() | F.col("_in").isNotNull()).alias("has_start"), (F.col("_stop") | F.col("_ahead").isNotNull()).alias("has_stop"),
    )
