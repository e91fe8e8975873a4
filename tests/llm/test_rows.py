"""Rows with null and repeated keys, very long texts and empty tables; language ID against sizes added up by hand."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import zstandard
from pyspark.sql import functions as F

from locusframe.llm import bpe, langid, licences, minhash, nearest, packing, tokenstore, warc

tokenizers = pytest.importorskip("public_tokenizers")

PROSE = "the words of this text are plain and there are some more of them than in a line"
NOTICE = "Licensed under the Apache License, Version 2.0."
ROWS = [(None, PROSE), (None, None), (7, PROSE), (7, PROSE), (7, PROSE + " but not these"), (8, NOTICE), (8, NOTICE), (9, ""), (None, NOTICE), (10, "a" * 3000), (11, (PROSE + "\n") * 4000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3).cache()


def texts():
    return [t or "" for _, t in ROWS]


def test_licences(docs):
    got = Counter((r.doc_id, r.licences) for r in licences.scan(docs).collect())
    assert got == Counter((i, "Apache-2.0" if t == NOTICE else "") for i, t in ROWS)
    assert licences.scan(docs.where("false")).count() == 0


def test_token_store(spark, docs):
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    store = tokenstore.write_store(docs, path, 2)
    rows = sorted(tokenstore.read_checksums(spark, store).collect(), key=lambda r: r.start)
    ids = [t.encode(x, add_special_tokens=False).ids + [2] for x in texts()]
    assert Counter((i, len(x), zlib.crc32(np.array(x, np.uint32).tobytes())) for (i, _), x in zip(ROWS, ids, strict=True)) == Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows)
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:k]) for k in range(len(rows))]
    assert [r.doc_id for r in rows] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))


def test_packing(docs):
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    want = Counter()
    for i, x in ROWS:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[i, k // 2048, k, len(ids[k:k + 2048])] += 1
    rows = packing.pack_documents(docs, path).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        assert [at for at, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 2048


def test_bpe(docs):
    import tiktoken

    path = tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = Counter()
    for i, x in ROWS:
        ids = np.array(enc.encode_ordinary(x or ""), "<u4")
        want[i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe.encode_documents(docs, path, tokenizers.PATTERN).collect()) == want


def test_warc(spark):
    html = "<p>" + "x" * 200
    rows = [(1, "http://a", html), (1, "http://b", html), (2, "http://a", html), (3, None, None), (3, "http://c", ""), (4, "http://d", "<p>" + "y" * 5_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(pages)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter((i, len(h or ""), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows)
    assert {(r.page_id, r.record_type, r.refers_to) for r in got if r.page_id in (2, 3, 4)} == {(2, "revisit", 1), (3, "response", None), (4, "response", None)}
    assert warc.read_archives(warc.write_archives(pages.where("false"))).count() == 0


def test_vectors(spark):
    rows = [(None, [1.0, 0.0]), (5, [1.0, 0.01]), (5, [1.0, 0.01]), (6, [0.0, 1.0]), (None, None), (7, [0.0, 0.0])]
    got = nearest.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert Counter((r.vec_id, r.n_links) for r in got) == Counter({(None, 2): 1, (5, 2): 2, (6, 0): 1, (None, 0): 1, (7, 0): 1})
    assert {r.component_id for r in got if r.n_links} == {5}


def test_near_duplicates(docs):
    got = minhash.cluster(docs, 2).collect()
    words = [regex.findall(r"[^\x20\x09-\x0D]+", t.lower()) for t in texts()]
    assert Counter((i, len(set(zip(w, w[1:], strict=False)) or {*w})) for (i, _), w in zip(ROWS, words, strict=True)) == Counter((r.doc_id, r.n_shingles) for r in got)
    assert {r.component_id for r in got if r.doc_id == 7} == {7} and {r.component_id for r in got if r.doc_id == 8} == {8}


def test_language_by_hand(spark):
    """Predictions are those of the smallest sum of compressed blocks over the dictionaries."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = langid.fit(docs.where(~langid.held_out()))
    assert len(learned) > 1
    long = " ".join(r.text for r in docs.where("text is not null").orderBy("doc_id").limit(40).collect())
    rows = [*((r.doc_id, r.text) for r in docs.collect()), (None, long), (7_000_000, long), (7_000_000, "123 !"), (None, None), (7_000_001, "")]
    want = Counter()
    for i, text in rows:
        if text is None or not regex.search(r"\p{L}", text):
            want[i, "und", True] += 1
            continue
        clean = regex.sub(r"\PL+", " ", text.lower()).encode()
        sizes = {}
        for lang, raw in learned.items():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(dict_data=d, level=6, write_content_size=False, write_checksum=False)
            sizes[lang] = sum(len(c.compress(clean[k:k + 16_384])) for k in range(0, len(clean), 16_384))
        best = min(sorted(sizes), key=sizes.get)
        runner = min(n for lang, n in sizes.items() if lang != best)
        want[i, best, (runner - sizes[best]) / runner < 0.01] += 1
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), learned).collect()
    assert Counter((r.doc_id, r.lang_pred, r.rejected) for r in got) == want
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.identify(docs.where(F.lit(False))).count() == 0
