"""Reports of spliced alignments: records of many lines, cut at their own mark, with a line of operations each."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: what a record of the report begins with.
MARK = "C4 Alignment:"
OPERATIONS = "array<struct<state:string,q:bigint,t:bigint>>"
EXONS = "array<struct<q_b:bigint,q_e:bigint,t_b:bigint,t_e:bigint,gap:string>>"


def operations(vulgar: Column) -> Column:
    """S21d: the operations of a `vulgar:` line in order: state, and how far it goes in query (q) and target (t)."""
    found = F.regexp_extract_all(F.regexp_extract(vulgar, r"^\S+(?:\s+\S+){9}(.*)$", 1), F.lit(r"([A-Z35]\s+\d+\s+\d+)"), 1)
    return F.transform(found, lambda o: F.struct(F.left(o, F.lit(1)).alias("state"), F.regexp_extract(o, r"\s(\d+)\s", 1).cast("bigint").alias("q"), F.regexp_extract(o, r"(\d+)$", 1).cast("bigint").alias("t")))


def closing_site(states: str) -> str | None:
    """Which splice site closes an exon: 5 where introns go from 5' to 3', 3 the other way round, None without introns.

    Introns without length tell by their sites alone. An alignment with both kinds, or with sites that tell neither, is an error."""
    for five, three in (("5I3", "3I5"), ("[A-HJ-Z]53|53[A-HJ-Z]", "[A-HJ-Z]35|35[A-HJ-Z]")):
        kinds = [site for site, pattern in (("5", five), ("3", three)) if re.search(pattern, states)]
        if len(kinds) == 2:
            raise ValueError(f"introns of both directions in one alignment: {states}")
        if kinds:
            return kinds[0]
    if re.search("[35]", states):
        raise ValueError(f"splice sites without a direction: {states}")
    return None


def _gap(state: str, q: int, t: int, unit: int) -> str:
    if state in "MC":
        return f"M{t // unit}"
    if state == "G" and t and t % unit == 0:
        return f"D{t // unit}"
    return f"F{t}" if t else f"I{q}"


def _exons(line: str | None) -> list[dict] | None:
    """The fold of one line; see exons."""
    f = (line or "").split()
    if len(f) < 10:
        return None
    ops = [(f[i], int(f[i + 1]), int(f[i + 2])) for i in range(10, len(f) - 2, 3)]
    close, unit = closing_site("".join(o[0] for o in ops)), 3 if f[4] == "." else 1
    q, q_end, t, t_end = int(f[2]), int(f[3]), int(f[6]), int(f[7])
    q_on, t_on = q < q_end, t < t_end
    q_way, t_way = -1 if f[4] == "-" else 1, -1 if f[8] == "-" else 1
    out: list[dict] = []
    begin, gap = None, ""
    for state, dq, dt in (*ops, (None, 0, 0)):
        if state is None or state == close:
            if begin:
                out.append({"q_b": begin[0], "q_e": q if q_on else q + 1, "t_b": begin[1], "t_e": t if t_on else t + 1, "gap": gap})
            begin, gap = None, ""
        elif state in "MGFSC":
            begin = begin or (q + 1 if q_on else q, t + 1 if t_on else t)
            gap += _gap(state, dq, dt, unit)
        elif state not in "53I":
            raise ValueError(f"an operation without a meaning: {state}")
        q, t = q + q_way * dq, t + t_way * dt
    return out


def exons(vulgar: Column) -> Column:
    """Exons of `vulgar:` lines: begins and ends in query and target, and gap.

    Begins and ends are 1-based, in the direction of the alignment (on the minus strand an exon's begin is its higher end). Exons without
    length go. gap: the exon's operations on its target, in codons where the query is a protein: M aligned, D target without query, I
    query without target, F bases of frame shifts and of codons that an intron splits. A null or cut line has null."""

    @F.pandas_udf(EXONS)
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(_exons)

    return run(vulgar)


def vulgar_hits(lines: DataFrame, column: str) -> DataFrame:
    """Alignments from `vulgar:` lines: query, target, score, q_strand, t_strand and their exons; other columns stay."""
    f = F.split(F.trim(F.col(column)), r"\s+")
    way = lambda c: F.when(c == "-", -1).otherwise(1)
    of = lambda i: F.get(f, F.lit(i))
    return lines.withColumns({"query": of(1), "target": of(5), "score": of(9).cast("double"), "q_strand": way(of(4)), "t_strand": way(of(8)), "exons": exons(F.col(column))})


def exonerate(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of spliced alignments of ESTs, cDNAs or proteins: query, target, model, score, strand (the target's), exon (from 1), s, e (on the
    target), q_b, q_e, gap (see `exons`). Records may go over the ends of file splits; those without operations are left out."""
    records = spark.read.option("lineSep", MARK).text(path)
    model = F.trim(F.regexp_extract("value", r"(?m)^\s+Model:[ \t]+(.*?)[ \t]*$", 1))
    lines = records.select(model.alias("model"), F.regexp_extract("value", r"(?m)^(vulgar: .*)$", 1).alias("line")).where("line <> ''")
    blocks = vulgar_hits(lines, "line").select("query", "target", "model", "score", F.col("t_strand").alias("strand"), F.posexplode("exons").alias("exon", "x"))
    return blocks.select("query", "target", "model", "score", "strand", (F.col("exon") + 1).alias("exon"), F.least("x.t_b", "x.t_e").alias("s"), F.greatest("x.t_b", "x.t_e").alias("e"), "x.q_b", "x.q_e", "x.gap")
