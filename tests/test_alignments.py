"""Spliced alignments against a fold by hand, and order-dependent groups against brute force."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from locusframe.operators import groups
from locusframe.sources import alignments

REPORT = """Command line: [exonerate --model x]
Hostname: [here]

{records}
-- completed exonerate analysis
"""
RECORD = """C4 Alignment:
------------
         Query: {query} some words
        Target: {target}
         Model: {model}
     Raw score: 321
   Query range: 0 -> 40
  Target range: 100 -> 400

    1 : ACGTACGT :   8
        ||||||||
  101 : ACGTACGT : 108

vulgar: {line}
"""
LINES = [
    ("est2genome", "est1 0 40 + ctg1 100 400 + 321 M 20 20 5 0 2 I 0 256 3 0 2 M 20 20"),
    ("est2genome", "est2 40 0 - ctg1 400 100 - 11 M 10 10 G 2 0 M 8 8 5 0 2 I 0 260 3 0 2 M 5 5 G 0 3 M 15 10"),
    ("est2genome", "est3 0 30 + ctg2 50 80 - 9.5 M 30 30"),
    ("cdna2genome", "cdna1 5 35 + ctg2 400 100 - 7 M 10 10 3 0 2 I 0 266 5 0 2 C 12 12 M 8 8"),
    ("protein2genome:local", "prot1 0 21 . ctg1 100 400 + 88 M 5 15 G 0 6 F 0 1 M 4 12 S 1 2 5 0 2 I 0 200 3 0 2 S 0 1 M 6 18 G 2 0 M 3 9"),
    ("protein2genome:local", "prot2 0 9 . ctg1 400 100 - 88 M 4 12 5 0 2 3 0 2 M 5 15"),
    ("est2genome", "est4 0 10 + ctg1 0 14 + 3 5 0 2 3 0 2 M 10 10"),
]


def fold(line):
    f = line.split()
    qb, qe, tb, te, qs, ts = int(f[1]), int(f[2]), int(f[5]), int(f[6]), -1 if f[3] == "-" else 1, -1 if f[7] == "-" else 1
    ops = [(f[i], int(f[i + 1]), int(f[i + 2])) for i in range(9, len(f), 3)]
    text, unit = "".join(o[0] for o in ops), 3 if f[3] == "." else 1
    close = "3" if "3I5" in text else "5"
    q, t, now, gap, out = qb, tb, None, "", []

    def end():
        if now:
            out.append((*now, q if qb < qe else q + 1, t if tb < te else t + 1, gap))

    for state, a, b in ops:
        if state in "MGFSC":
            now = now or (q + 1 if qb < qe else q, t + 1 if tb < te else t)
            if state in "MC":
                gap += f"M{b // unit}"
            elif state == "G" and b and b % unit == 0:
                gap += f"D{b // unit}"
            else:
                gap += f"F{b}" if b else f"I{a}"
        elif state == close:
            end()
            now, gap = None, ""
        q, t = q + qs * a, t + ts * b
    end()
    return [(f[0], f[4], float(f[8]), ts, k + 1, min(x[1], x[3]), max(x[1], x[3]), x[0], x[2], x[4]) for k, x in enumerate(out)]


@pytest.mark.parametrize("split", [1 << 20, 200])
def test_exonerate(spark, tmp_path, split):
    """Records are whole whatever the file splits."""
    path = tmp_path / "report.txt"
    path.write_text(REPORT.format(records="\n".join(RECORD.format(query=x.split()[0], target=x.split()[4], model=m, line=x) for m, x in LINES)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        rows = alignments.exonerate(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = sorted((r.query, r.target, r.score, r.strand, r.exon, r.s, r.e, r.q_b, r.q_e, r.gap) for r in rows)
    assert got == sorted(x for _, line in LINES for x in fold(line))
    assert {r.query: r.model for r in rows} == {line.split()[0]: m for m, line in LINES}
    # a protein's bases: codons, gaps and shifts add up to the block
    for r in rows:
        if r.query.startswith("prot"):
            assert sum(int(n[1:]) * {"M": 3, "D": 3, "F": 1, "I": 0}[n[0]] for n in __import__("re").findall(r"[A-Z]\d+", r.gap)) == r.e - r.s + 1
    (tmp_path / "none.txt").write_text(REPORT.format(records=""))
    assert alignments.exonerate(spark, str(tmp_path / "none.txt")).count() == 0


@pytest.mark.parametrize("line", ["q 0 9 + t 0 99 + 1 M 3 3 5 0 2 I 0 9 3 0 2 M 3 3 3 0 2 I 0 9 5 0 2 M 3 3", "q 0 9 + t 0 99 + 1 M 3 3 N 3 3 M 3 3", "q 0 9 + t 0 99 + 1 5 0 2"])
def test_alignments_without_a_meaning(spark, line):
    rows = alignments.vulgar_hits(spark.createDataFrame([("vulgar: " + line,)], "line string"), "line")
    with pytest.raises(PySparkException):
        rows.select("exons").collect()


def test_absorbed_groups(spark):
    r = random.Random(8)
    rows = [(g, i, s, s + r.randrange(5, 60)) for g in (1, 2) for i in range(120) for s in [r.randrange(1, 700)]]
    want = []
    for g in (1, 2):
        left = sorted(x[1:] for x in rows if x[0] == g)
        while left:
            (o, s, e), rest = left[0], left[1:]
            took = [x for x in rest if min(e, x[2]) - max(s, x[1]) + 1 > 0.5 * min(e - s + 1, x[2] - x[1] + 1)]
            want.append((g, o, min([s, *(x[1] for x in took)]), max([e, *(x[2] for x in took)]), 1 + len(took)))
            left = [x for x in rest if x not in took]
    frame = spark.createDataFrame(rows, "g long, i long, s long, e long").repartition(3)
    got = sorted(tuple(x) for x in groups.absorbed(frame, ["g"], "i").collect())
    assert got == sorted(want)
    assert max(x[4] for x in want) > 3
    first = []
    for g in (1, 2):
        made = []
        for o, s, e in sorted(x[1:] for x in rows if x[0] == g):
            at = next((m for m in made if any(min(e, q) - max(s, p) + 1 > 0.5 * min(e - s + 1, q - p + 1) for _, p, q in m)), None)
            if at is None:
                made.append(at := [])
            at.append((o, s, e))
        first += [(g, m[0][0], min(x[1] for x in m), max(x[2] for x in m), len(m)) for m in made]
    assert sorted(tuple(x) for x in groups.joined(frame, ["g"], "i").collect()) == sorted(first)
    assert groups.absorbed(frame.where("false"), ["g"], "i").count() == 0


def test_operations(spark):
    frame = spark.createDataFrame([("vulgar: " + line,) for _, line in LINES] + [(None,), ("vulgar: cut",)], "line string")
    got = {tuple(map(tuple, r.ops)) for r in frame.select(alignments.operations(F.col("line")).alias("ops")).collect() if r.ops is not None}
    want = {tuple((f[i], int(f[i + 1]), int(f[i + 2])) for i in range(9, len(f), 3)) for _, line in LINES for f in [line.split()]}
    assert got == want | {()}
    assert [r.exons for r in alignments.vulgar_hits(frame.where("line is null or line = 'vulgar: cut'"), "line").collect()] == [None, None]
