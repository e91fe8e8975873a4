"""Near duplicates by min-max hashing.

Every permutation gives both the minimum and the maximum of a document's shingle hashes, so 192
signature values cost 96 evaluations. A band takes both values of three permutations; at similarity
0.8 a band agrees with probability 0.26, and all 64 bands together miss such a pair about once in a
million. Documents with equal sets are one class from the start.

In each bucket the class with most company in all its buckets is the centre, and the others are
compared with it first; what is linked then isn't compared again. What a bucket of at most `small`
classes still holds apart is compared pair by pair. For larger buckets there is an exact way that
needs no pair of the group: two sets of similarity 0.8 share a shingle among their rarest fifth
(prefix filtering), so only classes that share such a shingle meet. No link between different
components is lost. Links are confirmed on full sets (64-bit shingle hashes, cut to 48 bits).

Null texts and texts without words have an empty set and link with nothing; texts with fewer words
than a shingle are one shingle. Rows with equal doc_ids count as documents of their own. Documents
with a null doc_id take part; component_id is null where no other doc_id is reachable. Texts of any
length count whole; an empty table gives no rows. The result has the named columns alone; other
columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.components import components
from locusframe.llm.shared import bounded_batches, stored
from locusframe.llm.wordcache import slices, strings

BANDS, PERMUTATIONS = 64, 96
_j = np.arange(32)
#: The three permutations of each band; every permutation stands in two bands, never with the same others.
TRIPLES = np.concatenate([np.stack([3 * _j, 3 * _j + 1, 3 * _j + 2]), np.stack([_j, _j + 32, _j + 64])], 1)
K1, K2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * K1
    x = (x ^ (x >> np.uint64(27))) * K2
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (what stands between ASCII white space), and the number of words of each text."""
    import xxhash

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten().dictionary_encode()
    names = strings(words.dictionary)
    raw = (w.encode().lower() for w in names) if lower else (w.encode() for w in names)
    of = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(names))
    code = words.indices.to_numpy()
    per_text = np.diff(lists.offsets.to_numpy())
    if "" in names:  # before leading and after trailing white space
        real = code != names.index("")
        per_text = np.bincount(np.repeat(np.arange(len(texts)), per_text)[real], minlength=len(texts))
        code = code[real]
    return of[code], per_text


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    h, n = word_hashes(texts)
    x = np.zeros(len(h), np.uint64)
    for i in range(words):
        m = len(h) - i
        x[:max(m, 0)] = mix(x[:max(m, 0)] + h[i:] + np.uint64(i + 1))
    end = 0
    for k in n.tolist():
        begin, end = end, end + k
        if k >= words:
            s = np.sort(x[begin:end - words + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif k:
            y = np.zeros(1, np.uint64)
            for i in range(k):
                y = mix(y + h[begin + i] + np.uint64(i + 1))
            yield mix(y + np.uint64(k << 8))
        else:
            yield x[:0]


_a = (np.random.default_rng(7).integers(0, 1 << 63, PERMUTATIONS, np.uint64) << np.uint64(1)) | np.uint64(1)


def bands_of(s: np.ndarray) -> np.ndarray:
    """BANDS hashes of a set that isn't empty."""
    low, high = np.full(PERMUTATIONS, ~np.uint64(0)), np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(s), 1024):
        p = s[i:i + 1024] * _a[:, None]
        np.minimum(low, p.min(1), out=low)
        np.maximum(high, p.max(1), out=high)
    v = mix(low) + high * K2
    a, b, c = v[TRIPLES]
    v = mix(mix(a * K1 + b) + c * K2 + np.arange(BANDS, dtype=np.uint64))
    return v.view(np.int64)


def _key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per document: doc_id, n_shingles, set_key, bands (empty for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b["text"], 4_000_000):
                sizes, keys, bands = [], [], []
                for s in shingle_sets(b["text"].slice(i, j - i), words):
                    sizes.append(len(s))
                    keys.append(_key(s))
                    bands.append(bands_of(s) if len(s) else np.zeros(0, np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in bands])])
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(bands)))], ["doc_id", "n_shingles", "set_key", "bands"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def _packed(docs: DataFrame, words: int) -> DataFrame:
    """set_key and the set's hashes, six bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b["text"], 4_000_000):
                sets = list(shingle_sets(b["text"].slice(i, j - i), words))
                packed = [np.unique(s >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(map(_key, sets), pa.binary()), pa.array(packed, pa.binary())], ["set_key", "packed"])

    return docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, "set_key binary, packed binary")


def _unpack(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist(), strict=True):
                n, m = len(x) // 6, len(y) // 6
                if 100 * min(n, m) < percent * max(n, m):
                    keep.append(False)
                    continue
                z = np.sort(np.concatenate([_unpack(x), _unpack(y)]))
                both = int(np.count_nonzero(z[1:] == z[:-1]))
                keep.append(100 * both >= percent * (n + m - both))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    size = F.octet_length("packed")
    left = sets.select(F.col("node").alias("a"), F.col("packed").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("packed").alias("y"))
    # sizes first: a pair whose sizes alone rule it out is not given its sets
    sized = pairs.join(sets.select(F.col("node").alias("a"), size.alias("p")), "a").join(sets.select(F.col("node").alias("b"), size.alias("q")), "b")
    sized = sized.where(F.least("p", "q") * 100 >= F.greatest("p", "q") * percent).select("a", "b")
    return sized.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _by_rare_shingles(crowd: DataFrame, percent: int) -> DataFrame:
    """crowd: node, component, packed. Pairs (a, b) of different components that share a shingle of both rarest parts.

    A set of n has a rarest part of n - ceil(n * percent / 100) + 1 shingles, in order of how many
    sets have them. A shingle that one set alone has, or one component, brings no pair."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                sets = [_unpack(x) for x in part["packed"].to_pylist()]
                n = np.array(list(map(len, sets)))
                row = pa.array(np.repeat(np.arange(len(n)), n))
                yield pa.RecordBatch.from_arrays([part["node"].take(row), part["component"].take(row), pa.array(np.concatenate(sets).astype(np.int64))], ["node", "component", "shingle"])

    rows = crowd.mapInArrow(shingles, "node long, component long, shingle long")
    # only shingles of several components can bring a pair; how many of a set's shingles are rarer than each is counted all the same
    common = rows.groupBy("shingle").agg(F.count("*").alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    ranked = stored(common.where("low < high").select("shingle", "df"))
    size = crowd.select("node", (F.octet_length("packed") / 6).cast("long").alias("size"))
    alone = rows.join(common.where("low = high").select("shingle", F.col("df")), "shingle").groupBy("node", "df").agg(F.count("*").alias("k"))
    rest = rows.join(ranked, "shingle").join(size, "node")
    order = Window.partitionBy("node").orderBy("df", "shingle")
    placed = rest.withColumn("place", F.row_number().over(order))
    before = alone.groupBy("node").agg(F.collect_list(F.struct("df", "k")).alias("alone"))
    rarer = F.aggregate(F.coalesce(F.col("alone"), F.expr("cast(array() as array<struct<df: bigint, k: bigint>>)")), F.lit(0).cast("long"), lambda s, x: s + F.when(x["df"] <= F.col("df"), x["k"]).otherwise(0))
    keep = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    at = placed.join(before, "node", "left").withColumn("at", F.col("place") + rarer)
    prefix = stored(at.where(F.col("at") <= keep).select("node", "component", "shingle", "size", "at"))
    right = prefix.select("shingle", F.col("node").alias("b"), F.col("component").alias("other"), F.col("size").alias("size_b"), F.col("at").alias("at_b"))
    # sets that share enough have room for it behind the first shingle that they share
    room = F.least(F.col("size") - F.col("at"), F.col("size_b") - F.col("at_b")) + 1
    enough = room * (100 + percent) >= (F.col("size") + F.col("size_b")) * percent
    close = F.least("size", "size_b") * 100 >= F.greatest("size", "size_b") * percent
    return prefix.withColumnRenamed("node", "a").join(right, "shingle").where((F.col("a") > F.col("b")) & (F.col("component") != F.col("other")) & close & enough).select("a", "b").distinct()


def cluster(docs: DataFrame, words: int = 5, percent: int = 80, small: int = 16, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept (whether it is its component's smallest doc_id)."""
    base = stored(signatures(bounded_batches(docs), words))
    classes = base.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(banded.join(shared, "band").select("band", "node", "n"))
    # who shares the most buckets with the most classes stands nearest to what a group has in common
    company = members.groupBy("node").agg(F.sum("n").alias("company"))
    company = stored(company.join(classes.select("node", "set_key", "rep"), "node"))
    centres = members.join(company.select("node", "company"), "node").groupBy("band").agg(F.max_by("node", F.struct("company", "node")).alias("centre"))
    # full sets of the classes that share a bucket; ids go to every task only behind a check of their number
    reps = company.select(F.col("rep").alias("doc_id")).distinct()
    chosen = docs.join(F.broadcast(reps) if reps.count() <= broadcast_rows else reps, docs["doc_id"].eqNullSafe(reps["doc_id"]), "left_semi")
    sets = stored(company.select("node", "set_key").join(_packed(chosen, words), "set_key").dropDuplicates(["node"]).select("node", "packed"))

    tried = stored(members.join(centres, "band").where("node <> centre").select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct())
    links = stored(_confirmed(tried, sets, percent))
    label = stored(components(links))
    named = members.join(label, "node", "left").select("band", "node", "n", F.coalesce("component", "node").alias("component"))
    mixed = named.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    apart = stored(named.join(mixed, "band"))
    few = apart.where(F.col("n") <= small)
    other = few.select("band", F.col("node").alias("b"), F.col("component").alias("other"))
    pairs = few.withColumnRenamed("node", "a").join(other, "band").where("a > b and component <> other").select("a", "b")
    crowd = apart.where(F.col("n") > small).select("node", "component").distinct()
    pairs = pairs.union(_by_rare_shingles(stored(crowd.join(sets, "node")), percent)).distinct().join(tried, ["a", "b"], "left_anti")
    links = stored(links.union(_confirmed(stored(pairs), sets, percent)))
    label = components(links)
    found = classes.select("set_key", "node", "rep").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = found.join(lowest, "component").select("set_key", "component_id")
    out = base.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept"))


#: The same rows by the sets of all pairs that share a shingle, for small tables (unique doc_ids; two words, 80 per cent).
SQL = r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM w),
    u AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM g),
    l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    m AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, m.y FROM r JOIN m ON m.x = r.y),
    c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
    SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c JOIN g USING (doc_id)"""
