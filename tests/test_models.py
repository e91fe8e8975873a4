import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from locusframe.functions import forms, sequences
from locusframe.operators import clusters, graphs, intervals
from locusframe.sources import fasta, gff3


def test_registers_without_a_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 100"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent, timeout=120)


def test_trace_walks_deep_and_round(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(40)]
    found = graphs.trace(spark.createDataFrame([*chain, *chain[:3]], "subject string, object string"))
    assert found.where("node = 'n0'").agg(F.count("*"), F.max("depth")).head() == (40, 40)
    cycle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "subject string, object string")
    assert {(r.node, r.ancestor, r.depth) for r in graphs.trace(cycle).where("node = 'a'").collect()} == {("a", "b", 1), ("a", "c", 2), ("a", "a", 3), ("a", "d", 3)}
    with pytest.raises(ValueError, match="cycle"):
        graphs.depths(cycle)


def test_depth_is_the_longest_way(spark):
    edges = spark.createDataFrame([("a", "root"), ("a", "b"), ("b", "c"), ("c", "root")], "subject string, object string")
    assert {r.node: r.depth for r in graphs.depths(edges).collect()} == {"a": 3, "b": 2, "c": 1}
    assert {r.node: r.depth for r in graphs.leaves_below(edges).collect()} == {"root": 3, "c": 2, "b": 1}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (60, 50), (7, 7)], "x long, y long")
    nodes = spark.range(62).withColumnRenamed("id", "node")
    found = {r.node: r.component for r in graphs.components(nodes, edges).collect()}
    assert found == {i: 0 if i <= 30 else 40 if i in (40, 50, 60) else i for i in range(62)}


def test_greedy_against_kept_rows(spark):
    rows = [("g", 1, 10, []), ("g", 2, 11, [10]), ("g", 3, 12, [11]), ("g", 4, 13, [12, 11]), ("h", 1, 11, None), ("h", 2, 10, [11])]
    df = spark.createDataFrame(rows, "k string, rank int, x long, others array<long>").repartition(3)
    assert {(r.k, r.x) for r in graphs.greedy(df, ["k"], "rank", "x", "others").collect()} == {("g", 10), ("g", 12), ("h", 11)}


@pytest.mark.parametrize(("bins", "flank"), [((64,), 0), ((8, 64, 512), 0), ((4, 1000), 5)])
def test_overlap_join_with_long_intervals(spark, bins, flank):
    draw = random.Random(7)

    def some(n):
        return [(i, s, s + draw.choice([0, 3, 30, 300, 3000])) for i, s in enumerate(draw.randrange(1, 4000) for _ in range(n))]

    a, b = some(50), some(60)
    left = spark.createDataFrame([("k", *x) for x in a], "k string, i long, s long, e long")
    right = spark.createDataFrame([("k", *x) for x in b], "k string, j long, s long, e long")
    expected = sorted((i, j) for i, s, e in a for j, p, q in b if s - flank <= q and p <= e + flank)
    assert sorted((r.i, r.j) for r in intervals.overlap_join(left, right, ["k"], flank, bin_sizes=bins).collect()) == expected
    met = {i for i, _ in expected}
    assert {r.i for r in intervals.overlap_join(left, right, ["k"], flank, "left_anti", bins).collect()} == {i for i, _, _ in a} - met
    assert sorted(r.i for r in intervals.overlap_join(left, right, ["k"], flank, "left_semi", bins).collect()) == sorted(met)


@pytest.mark.parametrize(("flank", "touch"), [(0, 1), (4, 1), (0, 0)])
def test_islands_by_blocks(spark, flank, touch):
    draw = random.Random(5)
    rows = sorted((s, s + draw.choice([0, 2, 40])) for s in (draw.randrange(1, 900) for _ in range(70)))
    number, end, expected = 0, None, []
    for s, e in rows:
        if end is None or s - flank > end + touch:
            number, end = number + 1, e + flank
        end = max(end, e + flank)
        expected.append((s, e, number))
    df = spark.createDataFrame([("k", *x) for x in rows], "k string, s long, e long")
    assert sorted((r.s, r.e, r.island) for r in intervals.islands(df, ["k"], flank, block=16, touch=touch).collect()) == sorted(expected)


def test_sweep_of_components(spark):
    draw = random.Random(8)
    rows = [(draw.randrange(12), s, s + draw.randrange(12)) for s in (draw.randrange(1, 200) for _ in range(40))]
    parent = {x: x for x, _, _ in rows}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for x, s, e in rows:
        for y, p, q in rows:
            if s <= q and p <= e:
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    df = spark.createDataFrame([("k", *x) for x in rows], "k string, node long, s long, e long")
    assert {r.node: r.component for r in clusters.components_in_groups(df, ["k"], "node").collect()} == {x: root(x) for x in parent}


def brute_orf(seq, start="", with_stop=False):
    table = sequences.codon_table()
    best = ("", 0)
    for f in range(3):
        p = "".join(table.get(seq[i:i + 3].upper().replace("U", "T"), "X") for i in range(f, len(seq) - 2, 3))
        at = 0
        for k, run in enumerate(runs := p.split("*")):
            skip = run.find(start) if start else 0
            if skip >= 0 and len(run) - skip > len(best[0].rstrip("*")) or (skip >= 0 and run[skip:] and len(run) - skip == len(best[0].rstrip("*")) and f + 3 * (at + skip) < best[1]):
                best = (run[skip:] + "*" * (with_stop and k < len(runs) - 1), f + 3 * (at + skip))
            at += len(run) + 1
    return best


def test_reading_frames(spark):
    draw = random.Random(9)
    seqs = ["".join(draw.choice("ACGTacgtuN") for _ in range(n)) for n in (0, 1, 2, 3, 8, 60, 200)] + ["ATG" * 5 + "TAA" + "ATGAAA", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, seq string")
    for options in ({}, {"start": "M"}, {"with_stop": True}, {"start": "M", "with_stop": True}):
        got = {r.i: r.o for r in df.select("i", sequences.longest_orf(F.col("seq"), **options).alias("o")).collect()}
        for i, s in enumerate(seqs):
            assert (got[i].peptide, got[i].offset) == ((None, None) if s is None else brute_orf(s, **options))
    both = df.select(sequences.longest_orf(F.col("seq"), both_strands=True).alias("o"), "seq").where("seq is not null").collect()
    for r in both:
        plus, minus = brute_orf(r.seq), brute_orf(r.seq.translate(str.maketrans(sequences.IUPAC, sequences.COMPLEMENT))[::-1])
        assert (r.o.peptide, r.o.strand) == ((minus[0], -1) if len(minus[0]) > len(plus[0]) else (plus[0], 1))


def test_forms(spark):
    rows = [("same", [(1, 10), (20, 30)], [(1, 10), (20, 30)]), ("part", [(1, 10), (20, 30), (40, 50)], [(1, 10), (20, 30)]), ("inner", [(20, 30)], [(1, 10), (20, 30), (40, 50)]), ("apart", [(1, 10)], [(20, 30)])]
    df = spark.createDataFrame(rows, "name string, a array<struct<s: long, e: long>>, b array<struct<s: long, e: long>>")
    x, y = forms.shadows(F.col("a"), F.col("b"))
    df = df.withColumns({"x": x, "y": y})
    a, b, x, y = (F.col(c) for c in "abxy")
    got = {r.name: r for r in df.select("name", "x", "y", forms.codes(a, b).alias("ab"), forms.same_form(a, b, x, y).alias("same"), forms.redundant_form(a, b, x, y).alias("redundant"), forms.redundant_form(b, a, y, x).alias("back")).collect()}
    assert (got["same"].ab, got["same"].same, got["same"].redundant) == ("11", True, True)
    assert (got["part"].ab, got["part"].same, got["part"].redundant, got["part"].back) == ("110", False, True, False)
    assert (got["inner"].ab, got["inner"].x, got["inner"].y) == ("1", "010", "111")
    assert (got["apart"].ab, got["apart"].same, got["apart"].redundant) == ("0", False, False)


def test_gff3_files(spark, tmp_path):
    block = gff3.gene_block(
        spark.createDataFrame([("g", "t1", "c", 1, 0.25, 0.5, "0|1"), ("g", "t2", "c", 1, 0.0, 1.0, "0|0")], "gene string, transcript string, seqid string, strand int, aed double, eaed double, qi string"),
        spark.createDataFrame([("t1", 1, 50), ("t1", 100, 149), ("t2", 1, 50)], "transcript string, s long, e long"),
        spark.createDataFrame([("t1", 11, 120)], "transcript string, cs long, ce long"),
    )
    path = str(tmp_path / "a.gff3")
    lines = [r.value for r in block.orderBy("place", "s").collect()]
    (tmp_path / "a.gff3").write_text("##gff-version 3\n" + "\n".join(lines) + "\n##FASTA\n>c one\nACGT\nAC\n>d\nGG\n")
    rows = gff3.read(spark, path)
    kinds = [(r["type"], r["s"], r["e"], r["phase"]) for r in rows.orderBy("type", "s").collect()]
    assert kinds == [("CDS", 11, 50, 0), ("CDS", 100, 120, 2), ("exon", 1, 50, None), ("exon", 100, 149, None), ("five_prime_UTR", 1, 10, None), ("gene", 1, 149, None), ("mRNA", 1, 149, None), ("ncRNA", 1, 50, None), ("three_prime_UTR", 121, 149, None)]
    exon = rows.where("type = 'exon' and s = 1").head().attributes
    assert exon["Parent"] == ["t1", "t2"]
    assert rows.where("type = 'mRNA'").head().attributes["_AED"] == ["0.25"]
    assert gff3.read(spark, path, seqid="d").count() == 0
    assert {(r.seqid, r.definition, r.seq) for r in gff3.embedded_fasta(spark, path).collect()} == {("c", "one", "ACGTAC"), ("d", "", "GG")}
    both = gff3.merged([rows, rows])
    assert both.where("type = 'gene'").count() == 1 and both.where("type = 'exon'").count() == 4
    assert gff3.merged([rows, rows], legacy=True).where("type = 'gene'").selectExpr("attributes['ID'][0] AS i").distinct().count() == 2
    assert gff3.merged([rows], models_only="other").count() == 0


def test_fasta_files(spark, tmp_path):
    (tmp_path / "x.transcripts.fasta").write_text(">a one\nAC\nGT\n>b\nTT\n")
    (tmp_path / "x.proteins.fasta").write_text(">a\nMK\n")
    assert fasta.count(spark, str(tmp_path)) == 3
    assert {(r.kind, r.seqid, r.seq) for r in fasta.merged(spark, str(tmp_path)).collect()} == {("transcripts", "a", "ACGT"), ("transcripts", "b", "TT"), ("proteins", "a", "MK")}
    names = spark.createDataFrame([("a", "new name")], "seqid string, new string")
    assert {(r.seqid, r.definition) for r in fasta.renamed(fasta.read(spark, str(tmp_path / "x.transcripts.fasta")), names).collect()} == {("new name", None), ("b", "")}
