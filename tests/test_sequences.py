import random

from pyspark.sql import functions as F

from locusframe.functions import attributes, sequences


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(column.alias("x")).head().x


def test_translation(spark):
    assert one(spark, sequences.translate(F.col("s"), 6), s="atgatgatgaaaaaauaa") == "MKK*"
    assert one(spark, sequences.translate(F.col("s")), s="at") == ""
    orf = one(spark, sequences.longest_orf(F.col("s")), s="atgaaaaaauaa")
    assert (orf.peptide, orf.offset) == ("MKK", 0)
    assert one(spark, sequences.translate(F.col("s"), 0, "mitochondrial"), s="TGAATA") == "WM"


def test_complement(spark):
    assert one(spark, sequences.reverse_complement(F.col("s")), s="ACGTNrya") == "tryNACGT"


def test_splice_codes(spark):
    pairs = [("gt", "ag"), ("ct", "ac"), ("at", "ac"), ("gt", "at"), ("aa", "aa")]
    df = spark.createDataFrame(pairs, ["d", "a"])
    assert "".join(r.x for r in df.select(sequences.splice_code(F.col("d"), F.col("a")).alias("x")).collect()) == "+-+-0"


def test_n50_as_written(spark):
    for lengths, expected in (([8, 4, 2, 2], 8), ([6, 5, 5], 6), ([9, 1], 5)):
        df = spark.createDataFrame([("g", "A" * n) for n in lengths], "k string, seq string")
        assert sequences.n50(df, ["k"]).head().n50 == expected


def test_masks(spark):
    seqs = spark.createDataFrame([(1, "ACGTACGT"), (2, "AAAA")], "seqid long, seq string")
    spans = spark.createDataFrame([(1, 2, 3), (1, 7, 20)], "seqid long, s long, e long")
    assert [r.seq for r in sequences.masked(seqs, spans).orderBy("seqid").collect()] == ["ANNTACNN", "AAAA"]
    assert [r.seq for r in sequences.masked(seqs, spans, hard=False).orderBy("seqid").collect()] == ["AcgTACgt", "AAAA"]


def test_attributes(spark):
    bag = attributes.parse(F.col("a"))
    df = spark.createDataFrame([("ID=x;Parent=a,b;Note=1%2C2;Note=z",)], ["a"]).select(bag.alias("m"), attributes.render(bag).alias("r"))
    row = df.head()
    assert row.m == {"ID": ["x"], "Parent": ["a", "b"], "Note": ["1,2", "z"]}
    assert row.r == "ID=x;Parent=a,b;Note=1%2C2,z"


def test_cigar(spark):
    for text in ("M8 D3 I10", "8M3D10I"):
        assert [tuple(x) for x in one(spark, attributes.cigar(F.col("s")), s=text)] == [("M", 8), ("D", 3), ("I", 10)]


def test_not_contained_of_any_length(spark):
    rows = [(1, "ACGTACGTACGTACGTACGTACGTAA"), (2, "GTACGTACGTACGTACGTACGTAA"), (3, "CGTAA"), (4, "GGG"), (5, "GGG"), (6, "GG"), (7, ""), (8, None), (9, "TTTTTTTTTTTTTTTTTTT"), (10, "TTTTTTTTTTTTTTTTTTTT"), (11, "CCC")]
    got = sequences.not_contained(spark.createDataFrame(rows, "seqid long, seq string"))
    assert sorted(r.seqid for r in got.collect()) == [1, 4, 10, 11]


def test_not_contained_meets_near_copies_by_length(spark):
    r = random.Random(5)
    base = "".join(r.choices("ACGT", k=700))
    near = [base[:k] + "N" + base[k + 1:] for k in range(300, 700, 5)]  # with one head, and of one length
    texts = [*near, *(base[i:j] for i, j in ((0, 1), (3, 19), (3, 20), (5, 90), (299, 320), (600, 700))), "".join(r.choices("ACGT", k=40)), "é" + base[:60], base[:60], "A" * 33, "A" * 32, ""]
    rows = list(enumerate(texts))
    expected = [i for i, a in rows if not any(len(b) > len(a) and a in b for b in texts)]
    df = sequences.not_contained(spark.createDataFrame(rows, "seqid long, seq string"))
    assert sorted(x.seqid for x in df.collect()) == expected
    # rows that meet by head: as many as sequences and lengths, not as pairs of near copies
    assert len(near) ** 2 > 20 * len(rows)
    assert "contains(" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def python_rows(plan):
    """Rows that each Python step of a plan that has run gave."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return python_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return python_rows(plan.plan())
    below = [n for i in range(plan.children().size()) for n in python_rows(plan.children().apply(i))]
    return below + ([plan.metrics().get("pythonNumRowsReceived").get().value()] if kind == "MapInArrowExec" else [])


def test_not_contained_makes_no_row_per_pair_of_one_head(spark):
    """Sequences that begin alike, of different lengths, and repeats of a few letters: rows are made for what is contained alone."""
    r = random.Random(6)
    base = "".join(r.choices("ACGT", k=1100))
    near = [base[:k] + "N" + base[k + 1:n] for k, n in ((600 + 2 * i, 1100 - i) for i in range(150))]
    inside = ["AC" * 700, "CA" * 600, "A" * 999, "A" * 3, base[:500]]
    rows = list(enumerate([*near, *inside, "AC" * 701, "A" * 1000]))
    expected = [i for i, a in rows if not any(len(b) > len(a) and a in b for _, b in rows)]
    df = sequences.not_contained(spark.createDataFrame(rows, "seqid long, seq string"))
    assert sorted(x.seqid for x in df.collect()) == expected
    assert 0 < max(python_rows(df._jdf.queryExecution().executedPlan())) < 3 * len(rows)


def test_windows_of_a_long_text_are_numbered_piece_by_piece(monkeypatch):
    text = "".join(random.Random(7).choices("ACGT", k=300))
    texts = [text, text[40:90], text[:5], "A"]
    whole = [(k, x.tolist()) for k, x in sequences._windows(texts, 99)]
    monkeypatch.setattr(sequences, "_AT_A_TIME", 7)
    assert [(k, x.tolist()) for k, x in sequences._windows(texts, 99)] == whole and len(whole) == 9
    assert whole[4][1][20] == sequences._ends(text[20:36])[0] and whole[4][1][300] == whole[4][1][40]


def test_empty_sequence_alone_is_kept(spark):
    rows = spark.createDataFrame([(1, ""), (2, ""), (3, None)], "seqid long, seq string")
    assert [x.seqid for x in sequences.not_contained(rows).collect()] == [1]


def test_masked_holds_no_batches_of_texts(spark):
    seqs = spark.createDataFrame([(1, "ACGTACGTAC"), (2, "ACGT"), (3, None), (4, ""), (5, "ACGTACGT")], "seqid long, seq string")
    pieces = spark.createDataFrame([(1, 2, 3), (1, 3, 5), (1, 9, 40), (1, 50, 60), (3, 1, 2), (4, 1, 1), (5, -3, 1), (5, 4, 4)], "seqid long, s long, e long")
    hard = sequences.masked(seqs, pieces)
    assert {r.seqid: r.seq for r in hard.collect()} == {1: "ANNNNCGTNN", 2: "ACGT", 3: None, 4: "", 5: "NCGNACGT"}
    soft = sequences.masked(seqs, pieces, hard=False, pad=1)
    assert {r.seqid: r.seq for r in soft.collect()} == {1: "acgtacGtac", 2: "ACGT", 3: None, 4: "", 5: "acgtaCGT"}
    assert "Python" not in hard._jdf.queryExecution().executedPlan().toString()
