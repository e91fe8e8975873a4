"""The pipeline's stages on the smallest table, each held against brute force on its own input."""

import corpus_pipeline as cp
from tests.llm.test_operators import brute_links, brute_windows

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        before = {r.doc_id: r.text or "" for r in docs.collect()}
        docs = spark.read.parquet(str(tmp_path / name))
        if i < len(cp.STAGES) - 1:
            assert docs.columns == cp.COLUMNS
        after = {r.doc_id: (r.text or "" if "text" in r else None) for r in docs.collect()}
        kept.append(len(after))
        if name == "language_id":
            assert set(after) <= set(before) and len(after) > 0.9 * len(before)
        elif name == "near_dedup":
            assert set(after) == {d for d, (_, _, first) in brute_links(before, 5, 80).items() if first}
        elif name == "substring_dedup":
            expected = {}
            for d, (n, gone, text) in brute_windows(before, 50).items():
                if not gone or gone < n:
                    expected[d] = text if gone else before[d]
            assert after == expected
        else:
            assert set(after) == set(before)
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "substring_dedup", "packing"]


def test_near_duplicates_by_row(spark):
    """Repeated and null doc_ids: one row of each group stays, and no row that has no copy goes."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a + " more"), (2, b), (3, c), (3, c), (None, a), (None, c), (None, "alone " * 3), (4, None), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (3, c), (None, "alone " * 3), (4, None), (4, None)], key=str)
