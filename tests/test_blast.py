"""Reports of BLAST searches, on own files cut anywhere."""

import pytest

from locusframe.sources import blast

NUCLEOTIDE = """BLASTN 2.2.28+

Database: est.fasta

Query= ctg1 some contig

Length=1,200
                                                                      Score     E
Sequences producing significant alignments:                          (Bits)  Value

  est1 a                                                               185    3e-46

> est1 a transcript
Length=300

 Score =  185 bits (100),  Expect = 3e-46
 Identities = 98/100 (98%), Gaps = 2/100 (2%)
 Strand=Plus/Plus

Query  101  ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGT  160
            ||||||||||||||||||||||||||||||||||||||||||||||||||||||||||||
Sbjct  1    ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGT  60

Query  161  ACGTACGTAC--ACGTACGTAC  180
            ||||||||||  ||||||||||
Sbjct  61   ACGTACGTACGTACGTACGTAC  82

 Score = 37.4 bits (20),  Expect = e-5
 Identities = 20/20 (100%), Gaps = 0/20 (0%)
 Strand=Plus/Minus

Query  400  ACGTACGTACGTACGTACGT  419
            ||||||||||||||||||||
Sbjct  200  ACGTACGTACGTACGTACGT  181

> est2
Length=50

 Score = 10.1 bits (5),  Expect = 4.0
 Identities = 5/5 (100%)
 Strand=Plus/Plus

Query  7  ACGTA  11
          |||||
Sbjct  3  ACGTA  7

Query= ctg2

Length=90

***** No hits found *****

Query= ctg3 old style
         (77 letters)

>est9 x
          Length = 40

 Score = 22.0 bits (11), Expect = 0.5
 Identities = 10/11 (90%)
 Strand = Plus / Minus

Query: 30 ACGTACGTACG 40
          |||| ||||||
Sbjct: 20 ACGTTCGTACG 10
"""
TRANSLATED = """BLASTX 2.2.28+
Query= ctg1
Length=1000

> prot1 kinase
Length=100

 Score = 80.5 bits (197),  Expect(2) = 1e-17, Method: Compositional matrix adjust.
 Identities = 40/50 (80%), Positives = 45/50 (90%), Gaps = 0/50 (0%)
 Frame = -2

Query  450  MKMKMKMKMK  301
            MKMKMKMKMK
Sbjct  11   MKMKMKMKMK  60
"""
TWICE = TRANSLATED.replace("BLASTX", "TBLASTX").replace("Frame = -2", "Frame = -2/+3").replace("Sbjct  11   MKMKMKMKMK  60", "Sbjct  11   MKMKMKMKMK  160")


@pytest.mark.parametrize("split", [1 << 20, 128])
def test_reports(spark, tmp_path, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = {}
        for program, text in (("blastn", NUCLEOTIDE), ("blastx", TRANSLATED), ("tblastx", TWICE)):
            (tmp_path / program).write_text(text)
            got[program] = sorted((tuple(r) for r in blast.report(spark, str(tmp_path / program), program).collect()), key=lambda r: (r[0], r[4], r[5]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got["blastn"] == [
        ("ctg1", 1200, "est1", 300, 1, 1, 185.0, 100.0, 3e-46, 98, 98, 100, 2, 1, 1, None, None, 101, 180, 1, 82),
        ("ctg1", 1200, "est1", 300, 1, 2, 37.4, 20.0, 1e-5, 20, 20, 20, 0, 1, -1, None, None, 400, 419, 181, 200),
        ("ctg1", 1200, "est2", 50, 2, 1, 10.1, 5.0, 4.0, 5, 5, 5, 0, 1, 1, None, None, 7, 11, 3, 7),
        ("ctg3", 77, "est9", 40, 1, 1, 22.0, 11.0, 0.5, 10, 10, 11, 0, 1, -1, None, None, 30, 40, 10, 20),
    ]
    assert got["blastx"] == [("ctg1", 1000, "prot1", 100, 1, 1, 80.5, 197.0, 1e-17, 40, 45, 50, 0, -1, 1, -2, None, 301, 450, 11, 60)]
    assert got["tblastx"] == [("ctg1", 1000, "prot1", 100, 1, 1, 80.5, 197.0, 1e-17, 40, 45, 50, 0, -1, 1, -2, 3, 301, 450, 11, 160)]


def test_kept_hits(spark, tmp_path):
    (tmp_path / "r").write_text(NUCLEOTIDE)
    found = blast.report(spark, str(tmp_path / "r"), "blastn")
    names = lambda *limits: sorted((r.query, r.subject, r.block) for r in blast.kept(found, *limits).collect())
    assert names(0, 10, 0, 0) == [("ctg1", "est1", 1), ("ctg1", "est1", 2), ("ctg1", "est2", 1), ("ctg3", "est9", 1)]
    assert names(30, 10, 0, 0) == [("ctg1", "est1", 1), ("ctg1", "est1", 2)]
    assert names(0, 1e-10, 0, 0) == [("ctg1", "est1", 1), ("ctg1", "est1", 2)]
    assert names(0, 10, 0.95, 0) == [("ctg1", "est1", 1), ("ctg1", "est1", 2), ("ctg1", "est2", 1)]
    assert names(0, 10, 0, 0.6) == [("ctg1", "est1", 1), ("ctg1", "est1", 2)]
