from pyspark.sql import functions as F

from locusframe.sources import fasta, gff3, reports


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


GFF = "\n".join(
    ["##gff-version 3", "c1\tmodel_gff:a\tgene\t1\t90\t.\t+\t.\tID=g1;Name=x%2Cy", "c1\tmodel_gff:a\tmRNA\t1\t90\t.\t+\t.\tID=t1;Parent=g1", "c1\tmodel_gff:a\texon\t1\t30\t.\t+\t.\tID=e1;Parent=t1,t2",
     "c1\tmodel_gff:a\tCDS\t61\t90\t.\t+\t0\tParent=t1", "c1\tmodel_gff:a\texon\t61\t90\t.\t+\t.\tParent=t1", "c1\tsnap\tmatch\t5\t9\t7.5\t.\t.\tID=m", "c1\t.\tcontig\t1\t99\t.\t.\t.\tID=c1", "", "##FASTA", ">c1", "ACGT"]
)


def test_gff3(spark, tmp_path):
    rows = gff3.read(spark, put(tmp_path, "a.gff", GFF))
    assert rows.count() == 7
    assert rows.where("type = 'gene'").head().attributes == {"ID": ["g1"], "Name": ["x,y"]}
    assert rows.where("type = 'match'").select("score", "strand").head() == (7.5, 1)
    assert gff3.by_parent(rows).where("parent = 't2'").count() == 1
    assert {r.evidence_type for r in gff3.routed(rows.where("type <> 'contig'")).collect()} == {"model", "pred"}
    m = gff3.models(rows).head()
    assert (m.gene, m.transcript, [tuple(x) for x in m.exons], [tuple(x) for x in m.cds]) == ("g1", "t1", [(1, 30), (61, 90)], [(61, 90)])
    gff3.write(rows, str(tmp_path / "out"))
    again = gff3.read(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
    gff3.store(gff3.routed(rows), str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).where("evidence_type = 'pred'").count() == 1


def test_fasta(spark, tmp_path):
    rows = fasta.read(spark, put(tmp_path, "a.fa", ">a first one\r\nACGT\r\nAC\n>b\nGG\n\n>c  x \n"))
    assert sorted(map(tuple, rows.collect())) == [("a", "first one", "ACGTAC"), ("b", "", "GG"), ("c", "x", "")]
    spark_text = [r.value for r in fasta.text(rows.where("seqid = 'a'"), 4).collect()]
    assert spark_text == [">a first one\nACGT\nAC"]
    assert fasta.lookup(rows, rows.where("seqid = 'b'")).count() == 1


def test_reports(spark, tmp_path):
    b = reports.blast_table(spark, put(tmp_path, "b", "q s e-10 0 50.5 120 a b c d 98.0 e f g h i j 1 90 + 11 100 + 0\n"))
    assert (b.head().evalue, b.head().bits, b.head().q_end, b.head().s_start) == (1e-10, 50.5, 90, 11)
    t = reports.trnascan(spark, put(tmp_path, "t", "Sequence\ttRNA\nc1 \t1\t90\t10\tLeu\t???\t50\t40\t61.2\nc1\t2\t5\t20\tAla\tAGC\t0\t0\t50\n"))
    assert sorted((r.name, r.strand, r.s, r.e) for r in t.collect()) == [("Ala-AGC", 1, 5, 20), ("Leu-NNN", -1, 10, 39), ("Leu-NNN", -1, 51, 90)]
    d = reports.domains(spark, put(tmp_path, "d", "p1\tx\t90\tPfam\tPF1\td\t5\t40\t1e-5\tT\t1-1\tIPR1\tn\tGO:0001|GO:0002\np1\tx\t90\tSeg\ts\ts\t1\t2\t?\tT\t1\n"))
    assert [(r.database, r.ipr, r.go) for r in d.collect()] == [("PFAM", "IPR1", "GO:0001")]
    j = reports.bed_junctions(spark, put(tmp_path, "j", "track x\nc1\t99\t300\tJ1\t5\t-\t99\t300\t255,0,0\t2\t20,30\t0,171\n"))
    assert [(r.part, r.s, r.e) for r in j.orderBy("part").collect()] == [(0, 100, 300), (1, 100, 119), (2, 271, 300)]
    g = reports.gtf_transcripts(spark, put(tmp_path, "g", 'c\tx\texon\t10\t19\t.\t+\t.\ttranscript_id "t";\nc\tx\texon\t30\t34\t.\t+\t.\ttranscript_id "t";\nc\tx\texon\t1\t2\t.\t.\t.\ttranscript_id "u";\n'))
    assert [(r.t_start, r.t_end) for r in g.orderBy("s").collect()] == [(1, 10), (11, 15)]
    nodes, edges = reports.obo(spark, put(tmp_path, "o", "format: 1\n\n[Term]\nid: A:1\nname: one\n\n[Term]\nid: A:2\nname: two\nis_a: A:1 ! one\nrelationship: part_of A:3 ! x\n\n[Typedef]\nid: part_of\n"))
    assert nodes.count() == 2
    assert sorted(map(tuple, edges.collect())) == [("A:2", "A:1", "isa"), ("A:2", "A:3", "part_of")]
    r = reports.repeatmasker(spark, put(tmp_path, "r", "  SW perc\nscore\n\n 320 1.0 0.0 0.0 c1 10 50 (9) C (AT)n Simple_repeat 1 2 3 4\n"))
    assert (r.head().s, r.head().strand, r.head().kind) == (10, -1, "simple")
    s = reports.snap(spark, put(tmp_path, "s", ">c7\nEinit 1 20 + 3.5 0 0 0 c7.1\nEterm 40 60 + 2 0 0 0 c7.1\n>c8\nEsngl 5 9 - 1 0 0 0 c8.1\n"))
    assert sorted((x.seqid, x.label, x.model) for x in s.collect()) == [("c7", "Einit", "c7.1"), ("c7", "Eterm", "c7.1"), ("c8", "Esngl", "c8.1")]
    h = spark.createDataFrame([("sp|P1|X Some protein OS=Homo sapiens GN=ABC PE=1",), ("UniRef50_A A thing n=3 Tax=Mus musculus RepID=X",), ("id plain words",)], ["h"]).select(reports.uniprot_headers(F.col("h")).alias("x"))
    assert [tuple(r.x) for r in h.collect()] == [("Some protein", "Homo sapiens", "ABC"), ("A thing", "Mus musculus", None), ("plain words", None, None)]
