"""Operators against brute force on small tables, with nulls, ties, empty and repeated rows, and clashing columns."""

import hashlib
import math
import shutil
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from locusframe.llm import bpe, components, fmindex, iblt, langid, licences, minhash, nearest, packing, substrings, tokenstore, warc
from locusframe.llm.wordcache import library_encoder

tokenizers = pytest.importorskip("public_tokenizers")

WORDS = "the of and to in that this with tion ing her was one all new far down out about".split()


def text(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] + (".\n" if r.random() < 0.05 else "") for i in r.integers(0, len(WORDS), n)).replace("\n ", "\n")


BASE = [text(i, 60 + 13 * i) for i in range(12)]
ODD = [None, "", " ", "one", "one two", "  a  b ", "x\n\ny \n", "é ü ß", "<|endoftext|> it's", "a" * 700, BASE[1], BASE[1], BASE[2] + " tail", BASE[3].replace("the", "teh", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de"][i % 2], "s", len(t or "")) for i, t in enumerate(BASE + ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def plain(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_tokens_and_packing(docs, empty):
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path, capacity=64, open_bins=4).collect()
    expected = {}
    for i, x in plain(docs).items():
        ids = t.encode(x, add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 64):
            expected[i, k // 64] = (k, len(ids[k:k + 64]), zlib.crc32(np.array(ids[k:k + 64], np.uint32).tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        end = 0
        for at, n in sorted(b):
            assert at == end
            end += n
        assert end <= 64
    assert packing.pack_documents(empty, path).count() == 0


def test_best_fit_in_rounds(spark):
    r = np.random.default_rng(1)
    items = spark.createDataFrame([(i, int(x)) for i, x in enumerate(r.integers(1, 100, 600))], "item long, length long")
    rows = packing.best_fit(items, capacity=100, open_bins=8, per_task=100, fan_in=4).join(items, "item").collect()
    bins = {}
    for x in rows:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert len(rows) == 600
    for b in bins.values():
        end = 0
        for at, n in sorted(b):
            assert at == end
            end += n
        assert end <= 100
    assert len(bins) < 1.15 * sum(x.length for x in rows) / 100 + 5


def test_token_store(spark, docs, empty):
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    store = tokenstore.write_store(docs, path, 2, cutter=tokenstore.Cutter(8, 4, 64))
    start, expected, ids = 0, [], {}
    for i, x in sorted(plain(docs).items()):
        ids[i] = t.encode(x, add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids[i]), zlib.crc32(np.array(ids[i], np.uint32).tobytes())))
        start += len(ids[i])
    assert sorted(map(tuple, tokenstore.read_checksums(spark, store).collect())) == expected
    assert {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in tokenstore.read_ids(spark, store).collect()} == ids
    chunks = spark.read.parquet(f"{store}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    assert tokenstore.read_checksums(spark, tokenstore.write_store(empty, path, 2)).count() == 0


@pytest.fixture(scope="module")
def store(spark, docs):
    return tokenstore.write_store(docs, tokenizers.path("byte_bpe_50k.json"), 2).removeprefix("file://")


def files(path):
    return sorted(p for p in Path(path).glob("*.parquet") if pq.read_metadata(p).num_rows)


def change(path, column, of):
    for p in files(path):
        t = pq.read_table(p)
        at = t.column_names.index(column)
        pq.write_table(t.set_column(at, t.field(column), pa.array(of(t[column].to_pylist()), t.field(column).type)), p)
        Path(p.parent, f".{p.name}.crc").unlink(missing_ok=True)


def gone(path):
    files(path)[0].unlink()


DAMAGE = {
    "chunk changed": (lambda s: change(f"{s}/chunks", "payload", lambda x: [b"\x01\x00" + v[2:] for v in x]), "digest"),
    "chunk file gone": (lambda s: gone(f"{s}/chunks"), "chunk"),
    "recipe file gone": (lambda s: gone(f"{s}/recipes"), "recipe file"),
    "all recipe files gone": (lambda s: [p.unlink() for p in files(f"{s}/recipes")], "recipe file"),
    "manifest gone": (lambda s: shutil.rmtree(f"{s}/manifest"), "manifest"),
    "manifest file gone": (lambda s: gone(f"{s}/manifest"), "sealed"),
    "head gone": (lambda s: shutil.rmtree(f"{s}/head"), "head"),
    "count changed": (lambda s: change(f"{s}/recipes", "n_tokens", lambda x: [v + 1 for v in x]), "recipe file"),
    "start changed": (lambda s: change(f"{s}/recipes", "start", lambda x: [v + 1 for v in x]), "recipe file"),
    "root changed": (lambda s: change(f"{s}/recipes", "root", lambda x: [b"x" * 32 for _ in x]), "recipe file"),
    "entries changed": (lambda s: change(f"{s}/recipes", "chunks", lambda x: [v[20:] + v[:20] if len(v) > 20 else b"y" * 20 for v in x]), "Merkle"),
    "recipe and manifest file gone": (lambda s: (gone(f"{s}/recipes"), gone(f"{s}/manifest")), "sealed"),
}


@pytest.mark.parametrize("damage", DAMAGE)
def test_damaged_store(spark, store, tmp_path, damage):
    path = str(tmp_path / "store")
    shutil.copytree(store, path)
    assert tokenstore.read_checksums(spark, path).count() == len(BASE + ODD)
    spark.catalog.clearCache()
    act, match = DAMAGE[damage]
    act(path)
    with pytest.raises(Exception, match=match):
        tokenstore.read_checksums(spark, path).collect()


def test_recipe_that_does_not_add_up(spark, store, tmp_path):
    """A store sealed over wrong counts: the entries tell."""
    path = str(tmp_path / "store")
    shutil.copytree(store, path)
    change(f"{path}/recipes", "n_tokens", lambda x: [v + 1 for v in x])
    for part in ("manifest", "head"):
        shutil.rmtree(f"{path}/{part}")
    tokenstore._manifest(spark, path).write.parquet(f"{path}/manifest")
    tokenstore._head(spark.read.parquet(f"{path}/manifest")).write.parquet(f"{path}/head")
    with pytest.raises(Exception, match="add up"):
        tokenstore.read_checksums(spark, path).collect()


def test_long_matches():
    """Positions beyond 22 bits, and pairs of one rank that overlap, against the tiktoken library."""
    import random

    import tiktoken

    ranks = bpe.read_ranks(tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own, r = bpe.RankBPE(ranks, tokenizers.PATTERN), random.Random(3)
    parts = ["a" * 4097, "ab" * 300, "aab" * 211, "abcabcab" * 40, "é" * 300, "".join(r.choice(WORDS) for _ in range(250)), "".join(r.choice("abcdefgh") for _ in range(900))]
    parts = [p.encode() for p in parts]
    want = [enc._encode_single_piece(p) for p in parts]
    flat, n = own.pieces(parts)
    assert n.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]
    for far in (0, 4_194_200, 1 << 30):
        own.db.register("start", pa.table({"piece": pa.array([i for i, p in enumerate(parts) for _ in p], pa.int32()), "pos": pa.array([far + i for p in parts for i in range(len(p))], pa.int32()), "tok": pa.array(own.of_byte[np.frombuffer(b"".join(parts), np.uint8)])}))
        assert own.db.sql(bpe.CONTRACT_LONG).to_arrow_table()["ids"].to_pylist() == want
        own.db.unregister("start")


def test_crc_of_parts():
    a, b, c = b"some bytes", b"", b"and more of them"
    parts = [(zlib.crc32(a), len(b + c)), (zlib.crc32(b), len(c)), (zlib.crc32(c), 0)]
    x = tokenstore.crc_before(np.array([p for p, _ in parts]), np.array([n for _, n in parts]))
    assert np.bitwise_xor.reduce(x) == zlib.crc32(a + b + c)


def test_byte_bpe(docs, empty):
    import tiktoken

    path = tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    expected = {}
    for i, x in plain(docs).items():
        ids = enc.encode_ordinary(x)
        expected[i] = (len(ids), hashlib.sha256(np.array(ids, np.uint32).tobytes()).hexdigest(), hashlib.sha256(x.encode()).hexdigest(), ids)
    got = bpe.encode_documents(docs, path, tokenizers.PATTERN, with_ids=True).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in got} == expected
    assert bpe.encode_documents(empty, path, tokenizers.PATTERN).count() == 0


def test_chunks_equal_whole_texts():
    from tokenizers import Tokenizer

    texts = ["", None, " a", "a ", "x  y ", " \n a", "a\n\nb", "it's 'tis don't x", "x. y.\nz,", "x.\n y", "\nabc", "hello***\nworld", "12.\n34", "a.\n", "\n", "tab\t.\nq", "é ́a", " x  y"]
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = tokenizers.path(name)
        t = Tokenizer.from_file(path)
        ids, n = library_encoder(path, spaced).encode(pa.array(texts))
        ends = np.cumsum(n)
        for x, k, e in zip(texts, n.tolist(), ends.tolist(), strict=True):
            assert ids[e - k:e].tolist() == t.encode(x or "", add_special_tokens=False).ids, x


def odd_texts(seed, n):
    """Random texts of pieces that tokenizers treat apart: marks, white space, special strings, letters that change when lower-cased."""
    r = np.random.default_rng(seed)
    some = ["a", "b", "the", "İ", "é", "e\u0301", "ß", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!", "'s", "'", "1", "42", "<|endoftext|>", "<|startoftext|>", "~", "日本語", "ไทย", "\u0307", "ﬁ", "😀", "-", "%", "İ.", "THE", "|", "x'll"]
    return ["".join(some[i] for i in r.integers(0, len(some), r.integers(0, 14))) for _ in range(n)]


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_library_on_odd_texts(name, spaced):
    from tokenizers import Tokenizer

    texts, path = odd_texts(3, 5000), tokenizers.path(name)
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    encoder = library_encoder(path, spaced)
    for limit in (encoder.limit, 100):  # a full cache forgets
        encoder.limit, kept = limit, encoder.limit
        got = []
        for i in range(0, len(texts), 500):
            ids, n = encoder.encode(pa.array(texts[i:i + 500]))
            got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        encoder.limit = kept
        assert got == expected


def test_ranks_on_odd_texts():
    import tiktoken

    path = tokenizers.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    ranks, chunks = bpe.coder(path, tokenizers.PATTERN)
    texts = [*odd_texts(4, 3000), "a" * 300 + " x " + "thereandback" * 30, "日本語" * 40]
    ids, n = chunks.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [enc.encode_ordinary(x) for x in texts]
    assert list(ranks.decode(ids, n)) == [x.encode() for x in texts]


def test_warc(spark):
    big = "<p>" + "x" * 200
    rows = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, "small"), (4, "http://d", "small"), (5, "http://e", None), (6, "u", "é" * 60), (0, "z", big), (None, "n", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = {r.page_id: r for r in warc.read_archives(warc.write_archives(pages), with_payload=True).collect()}
    assert len(got) == len(rows)
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {0: ("response", None), 1: ("revisit", 0), 2: ("revisit", 0), None: ("revisit", 0), **{k: ("response", None) for k in (3, 4, 5, 6)}}
    for k, _, html in rows:
        raw = (html or "").encode()
        assert (got[k].payload_bytes, got[k].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert got[k].payload == (None if got[k].record_type == "revisit" else raw)
    assert warc.read_archives(warc.write_archives(pages.where("false"))).count() == 0


def test_warc_dictionary(spark):
    import zstandard

    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://x").alias("url"), F.concat(F.lit("<html><body><p>common words that all pages share "), F.col("id") * 7919, F.lit("</p></body></html>")).alias("html")).coalesce(1)
    manifest = sorted(warc.write_archives(pages).collect(), key=lambda r: -r.records)
    raw = open(manifest[0].file.removeprefix("file://"), "rb").read()
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little")
    n = int.from_bytes(raw[4:8], "little")
    assert zstandard.get_frame_parameters(raw[8 + n:8 + n + 64]).dict_id == zstandard.ZstdCompressionDict(raw[8:8 + n]).dict_id() != 0


def brute_links(texts, words, percent):
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


@pytest.mark.parametrize("small", [1, 16])
def test_near_duplicates(spark, docs, empty, small):
    r = np.random.default_rng(4)
    base = [f"w{i}" for i in range(60)]
    more = []
    for i in range(40):  # a crowd of near copies, some within 0.8 of each other and some not
        w = list(base)
        for k in r.choice(60, int(r.integers(1, 9)), replace=False):
            w[k] = f"e{i}x{k}"
        more.append((100 + i, " ".join(w)))
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in minhash.cluster(both, 2, 80, small=small).collect()}
    assert got == brute_links(plain(both), 2, 80)
    assert minhash.cluster(empty, 2).count() == 0


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (7, 7), (4, 20), (20, 11)], "a long, b long")
    for block in (1, 2, 100):
        assert {r.node: r.component for r in components.components(e, block).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 11: 1, 20: 1, 8: 8, 9: 8}
    assert components.components(e.where("false")).count() == 0


def brute_windows(texts, window):
    seen, out = {}, {}
    for i in sorted(texts):
        w = texts[i].encode().split()
        gone, new = [False] * len(w), []
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if key in seen:
                gone[k:k + window] = [True] * window
            else:
                new.append(key)
        for key in new:
            seen[key] = i
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    return out


@pytest.mark.parametrize(("window", "hot"), [(13, 50_000), (13, 1), (20, 50_000), (1, 50_000), (2, 1)])
def test_substrings(docs, empty, window, hot):
    odd = docs.withColumnsRenamed({"lang": "doc", "source": "key"}).withColumn("gone", F.lit(1))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substrings.dedup(odd, window, hot_docs=hot).collect()}
    assert got == brute_windows(plain(docs), window)
    assert substrings.dedup(docs, window, most_broadcast_bytes=0).count() == len(got)
    assert substrings.dedup(empty, window).count() == 0


@pytest.mark.parametrize("hot", [2, 20_000])
def test_substrings_of_shared_passages(spark, hot):
    r = np.random.default_rng(11)
    passages = [[f"p{j}x{k}" if r.random() < 0.5 else WORDS[k % len(WORDS)] for k in range(int(n))] for j, n in enumerate(r.integers(12, 60, 8))]
    texts = {}
    for i in range(70):
        w = []
        for _ in range(int(r.integers(0, 6))):
            p = passages[int(r.integers(0, len(passages)))]
            a, b = sorted(r.integers(0, len(p) + 1, 2).tolist())
            w += p[a:b] + [WORDS[x] for x in r.integers(0, len(WORDS), int(r.integers(0, 5)))]
        texts[i] = " ".join(w)
    texts |= {200 + i: texts[i] for i in range(0, 70, 3)} | {300 + i: texts[1] + f" end {i}" for i in range(30)}
    rows = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(7)
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_text) for x in substrings.dedup(rows, 13, hot_docs=hot).collect()}
    assert got == brute_windows(texts, 13)


def test_substrings_of_odd_rows(spark):
    """Equal rows, equal doc_ids with other texts, null doc_ids, and one very long text."""
    long = " ".join(WORDS[i] for i in np.random.default_rng(1).integers(0, len(WORDS), 1_300_000))
    a, b = text(501, 40), text(502, 40)
    rows = spark.createDataFrame([(5, long), (5, long), (7, a), (7, b), (8, a + " " + b), (None, a), (None, a), (9, None), (None, None), (10, long[:400])], "doc_id long, text string")
    got = sorted(((x.doc_id is None, x.doc_id), x.n_words, x.n_removed) for x in substrings.dedup(rows, 13).collect())
    n = lambda t: len(t.split())
    assert got[:2] == [((False, 5), 1_300_000, 0)] * 2
    assert got[2:4] == sorted([((False, 7), n(a), 0), ((False, 7), n(b), 0)])
    assert got[4][0] == (False, 8) and got[4][1] - got[4][2] == 0
    assert got[5] == ((False, 9), 0, 0)
    assert got[6][0] == (False, 10) and got[6][2] >= n(long[:400]) - 1
    assert got[7:] == [((True, None), 0, 0), ((True, None), n(a), n(a)), ((True, None), n(a), n(a))]


def test_fm_index():
    r = np.random.default_rng(2)
    runs = [r.integers(1, 4, n) for n in (5, 6, 9, 5, 7, 5, 8) * 4]
    owner = r.permutation(len(runs)).astype(np.int64)
    least, count = fmindex.earliest((np.concatenate(runs), np.array(list(map(len, runs)))), owner, 5)
    first = {}
    for x, o in zip(runs, owner.tolist(), strict=True):
        for k in range(len(x) - 4):
            first[tuple(x[k:k + 5])] = min(first.get(tuple(x[k:k + 5]), 1 << 60), o)
    assert least.tolist() == [first[tuple(x[k:k + 5])] for x in runs for k in range(len(x) - 4)]
    assert count.tolist() == [len(x) - 4 for x in runs]


@pytest.mark.parametrize("part_bytes", [300, 24_000_000])
def test_fingerprints(docs, empty, part_bytes):
    texts = plain(docs)
    ids = sorted(texts)
    got = {r.doc_id: r for r in iblt.fingerprints(docs.withColumn("part", F.lit("x")).withColumn("extra", F.lit(1)), part_bytes=part_bytes).collect()}

    def units(t):
        return {" ".join(w[k:k + 8]) for line in t.split("\n") for w in [line.split()] for k in range(0, len(w), 8)}

    def like(a, b):
        return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0

    for i, k in zip(ids, ids[1:] + ids[:1], strict=True):
        t, u = texts[i], texts[k]
        e = t[:len(t) - len(t) // 2] + u[:len(t) // 2]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert r.near_edited == pytest.approx(like(units(t), units(e)))
        assert r.near_next == pytest.approx(like(units(t), units(u)))
    assert isinstance(got[22].fingerprint, str) and isinstance(got[22].edited_fingerprint, str)
    assert got[22].fingerprint == got[23].fingerprint == got[1].fingerprint
    assert iblt.fingerprints(empty).count() == 0


def test_fingerprints_with_ties(spark):
    rows = [(None, "n"), (3, "b"), (3, "a"), (7, "z"), (7, "z")]
    got = iblt.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars) for r in got) == [(False, 0, 1), (True, 3, 1), (True, 3, 1), (True, 7, 1), (True, 7, 1)]


def test_ranges(spark):
    from locusframe.llm.shared import is_cut, range_of

    cuts = [-5, 0, 3, 10, 11, 40, 41, 42, 100, 1000]
    values = [None, -9, -5, -1, 0, 2, 3, 9, 10, 11, 39, 40, 42, 43, 999, 1000, 5000]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", range_of("v", cuts).alias("r"), is_cut("v", cuts).alias("c")).collect()
    for row in rows:
        assert row.r == (0 if row.v is None else sum(c <= row.v for c in cuts))
        assert bool(row.c) == (row.v in cuts)


def brute_vectors(rows, threshold):
    good = {i: np.array(v, float) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    links = {i: [j for j in unit if j != i and len(unit[j]) == len(unit[i]) and unit[i] @ unit[j] >= threshold] for i in unit}
    out = {}
    for i, _ in rows:
        reach, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        out[i] = (len(links.get(i, [])), min(reach), min(reach) == i)
    return out


def test_vectors(spark):
    r = np.random.default_rng(3)
    centre = r.normal(size=(6, 16))
    rows = [(i, (centre[i % 6] + 0.05 * r.normal(size=16)).tolist()) for i in range(120)] + [(200 + i, r.normal(size=16).tolist()) for i in range(60)]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] + [1.0] * 15), (303, [None] + [1.0] * 15), (304, [1.0, 0.0]), (305, [1.0, 0.01]), (306, rows[0][1]), (307, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in nearest.link(df, k=4, block=16).collect()}
    assert got == brute_vectors(rows, 0.9)
    assert nearest.link(df.where("false")).count() == 0


def test_vectors_sparse(spark):
    """Pairs just over the threshold whose other neighbours are all far away, so that only the orders find them."""
    r, n = np.random.default_rng(3), 20_000
    v = r.normal(size=(n, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    u = r.normal(size=(2000, 64))
    u -= (u * v[:2000]).sum(1, keepdims=True) * v[:2000]
    v[2000:4000] = 0.905 * v[:2000] + math.sqrt(1 - 0.905**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    df = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<double>")
    got = {x.vec_id: x.component_id for x in nearest.link(df).collect()}
    assert np.mean([got[2000 + i] == i for i in range(2000)]) > 0.985
    assert [nearest.orders(x, 0.9, 8) > 16 for x in (100, 20_000, 1_000_000)] == [False, True, True]


def test_audit_sees_beside_a_hot_group(spark):
    """All of a group of 300 is found, and none of 60 lone pairs."""
    v = np.eye(128)[[127] * 300 + [i for i in range(60) for _ in range(2)]]
    nodes = spark.createDataFrame([(i, x, 1) for i, x in enumerate(v.tolist())], "node long, vec array<double>, copies long")
    linked = spark.createDataFrame([(i, 299) for i in range(300)], "node long, linked long")
    seen = spark.createDataFrame([], "a long, b long, sim double, half int")
    assert nearest._audit(nodes, linked, seen, 128, 0.9, 512) < 0.5
    whole = linked.union(spark.createDataFrame([(300 + i, 1) for i in range(120)], "node long, linked long"))
    assert nearest._audit(nodes, whole, seen, 128, 0.9, 512) == 1


def test_recapture_of_rare_links(spark):
    """Of 80 lone pairs the second half saw 60, of which the first saw 30; a crowd's links don't count."""
    lone = [(2 * i, 2 * i + 1, 0.95, 3 if i < 30 else 2 if i < 60 else 1) for i in range(80)]
    crowd = [(1000 + i, 1000 + j, 0.99, 1 + (i + j) % 2) for i in range(30) for j in range(i)]
    seen = spark.createDataFrame(lone + crowd, "a long, b long, sim double, half int")
    assert nearest._recaptured(seen, 0.9, 64) == pytest.approx(0.75)
    assert nearest._recaptured(seen.where("a < 0"), 0.9, 64) == 1


@pytest.mark.parametrize("block", [16, 4096])
def test_counts_within_a_component(spark, block):
    r = np.random.default_rng(9)
    v = r.normal(size=(150, 8)) + np.array([3.0] + [0.0] * 7)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    copies = r.integers(1, 4, 150)
    rows = spark.createDataFrame([(i % 2, i, v[i].tolist(), int(copies[i])) for i in range(150)], "component long, node long, vec array<double>, copies long")
    near = (u @ u.T >= 0.9) & ~np.eye(150, dtype=bool) & (np.arange(150)[:, None] % 2 == np.arange(150) % 2)
    assert {x.node: x.linked for x in nearest._within(rows, 8, 0.9, block).collect()} == dict(enumerate((near * copies).sum(1).tolist()))


def test_fit_with_repeated_rows(spark):
    """Equal rows are learned once, whole; rows without an id or over the length are not learned."""
    rows = [(1, "en", "the cat and the hat")] * 3000 + [(2, "en", "xx " * 9000), (None, "en", "no id here"), (3, "de", "der hut und die katze"), (4, None, "unknown")]
    learned = langid.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert {k: v.decode() for k, v in learned.items()} == {"en": "the cat and the hat", "de": "der hut und die katze"}


def test_languages(spark, docs, empty):
    one, two = ["alpha beta gamma delta epsilon zeta", "eins zwei drei vier fuenf sechs"], ["en", "de"]
    r = np.random.default_rng(5)
    rows = [(i, " ".join(r.choice(one[i % 2].split(), 40)), two[i % 2]) for i in range(300)] + [(900, "123 !?", "en"), (901, None, "de"), (902, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {x.doc_id: x for x in langid.identify(df).collect()}
    assert len(got) == len(rows)
    right = [got[i].lang_pred == two[i % 2] for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean(right) > 0.98
    assert {got[i].lang_pred for i in (900, 901, 902)} == {"und"}
    assert langid.identify(empty).count() == 0


def test_languages_of_long_texts(spark):
    """A clean text isn't rejected for being long: the margin stays what it is for a tenth of it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = langid.fit(docs.where(~langid.held_out()))
    texts = [r.text for r in docs.where(langid.held_out() & F.col("text").isNotNull() & (F.col("lang") == "en")).orderBy("doc_id").collect()]
    whole = " ".join(texts)
    whole = (whole * (3_000_000 // len(whole) + 1))[:3_000_000]
    rows = spark.createDataFrame([(1, whole[:300_000]), (2, whole)], "doc_id long, text string")
    got = {x.doc_id: x for x in langid.predict(rows, learned).collect()}
    assert all(got[i].lang_pred == "en" and not got[i].rejected for i in (1, 2))
    assert abs(got[2].margin / got[1].margin - 1) < 0.1


def test_licences(spark):
    rows = [(1, "x\nLicensed under the Apache License, Version 2.0.\ny"), (2, "All rights\nreserved."), (3, None), (4, ""), (5, "plain prose that names no licence at all"), (6, "MIT LICENSE: released under the MIT license")]
    got = {r.doc_id: (r.n_matches, r.licences) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (2, "Apache-2.0")  # the line, and the block that it stands in
    assert got[2] == (1, "Proprietary")
    assert all(got[i] == (0, "") for i in (3, 4, 5))


def clashing(df):
    """df with columns of the names that operators use inside."""
    for name in ("row", "rid", "node", "band", "bucket", "shard", "slice", "key", "doc", "digest", "payload", "kind", "n", "part", "extra", "item", "task", "vec", "component", "first", "score", "_text", "_row"):
        df = df.withColumn(name, F.lit("x"))
    return df


def test_other_columns_of_any_name(spark, docs):
    """The same rows come out whatever other columns a table has."""
    small = docs.where("doc_id < 16")
    word, byte, ranks = (tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    pick = lambda df, *cols: sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    runs = [
        lambda d: pick(licences.scan(d), "doc_id", "n_matches"),
        lambda d: pick(tokenstore.read_checksums(spark, tokenstore.write_store(d, byte, 2)), "doc_id", "start", "ids_crc32"),
        lambda d: pick(langid.identify(d), "doc_id", "lang_pred"),
        lambda d: pick(minhash.cluster(d, 2), "doc_id", "component_id"),
        lambda d: pick(packing.pack_documents(d, word), "doc_id", "piece", "length"),
        lambda d: pick(substrings.dedup(d), "doc_id", "n_removed"),
        lambda d: pick(bpe.encode_documents(d, ranks, tokenizers.PATTERN), "doc_id", "ids_sha256"),
    ]
    for run in runs:
        assert run(clashing(small)) == run(small)
    pages = spark.createDataFrame([(i, f"http://{i % 3}", "<p>" + "y" * 150 * (i % 2)) for i in range(6)], "page_id long, url string, html string")
    assert pick(warc.read_archives(warc.write_archives(clashing(pages))), "page_id", "record_type") == pick(warc.read_archives(warc.write_archives(pages)), "page_id", "record_type")
    vectors = spark.createDataFrame([(i, [1.0, float(i % 2), 0.5]) for i in range(6)], "vec_id long, embedding array<double>")
    assert pick(nearest.link(clashing(vectors)), "vec_id", "n_links") == pick(nearest.link(vectors), "vec_id", "n_links")
