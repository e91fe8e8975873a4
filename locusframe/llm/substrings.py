"""Removes word windows that also start in a document with a smaller doc_id.

A window is `window` consecutive words; a word goes if any such window covers it. Shards are dealt by
content: a window belongs to the shard of its minimizer (the least hash among its k-word grams), so
equal windows meet in one shard, and consecutive windows with one minimizer travel as one segment.
Every document against the index of every other shard would grow with the square of the corpus.

1. Slices of documents ask buckets which of their minimizers other documents have too: an entry per
   slice and minimizer, with the number of its documents.
2. Slices cut the segments around such minimizers and send each distinct one once to its shard, with
   the smallest and largest doc_id that has it. Documents whose whole text an earlier document has
   need no search. A minimizer that very many documents have would gather their segments in one
   shard: its windows go one by one, by their own hash.
3. Each shard builds a compressed FM-index of its segments and streams them through it: backward
   search over the wavelet matrix gives the matching statistic at every word, up to the window's
   length. Where it reaches that length, the smallest doc_id in the range found goes back to the slice.
4. Slices put the intervals together for each document, and a last pass takes the covered words out.

Lists that come back to documents go to every task only behind a check of their size; beyond it they
are joined by a shuffle.

Null texts have no words. Null doc_ids count as the largest. Rows that are equal in doc_id and text
get equal results; rows with one doc_id but other texts are judged apart and never remove words
from one another. Texts of any length are taken whole. An empty table gives no rows. Columns of docs
named n_words, n_removed or kept_text are replaced by the results; others, whatever their names, stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.fmindex import earliest
from locusframe.llm.minhash import mix, word_hashes
from locusframe.llm.shared import bounded_batches, ranges_for, stored
from locusframe.llm.wordcache import slices

LAST = (1 << 63) - 1
SLICE = 5_000_000  # bytes of text
#: What travels between slices and buckets or shards: n entries, or -n documents of the slice itself.
PACK = "slice long, n int, docs binary, a binary, b binary, c binary, d binary, e binary"
PACK_TYPES = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
PACK_NAMES = ["slice", "n", "docs", "a", "b", "c", "d", "e"]


class Runs:
    """The windows of a slice of texts, cut into runs with one minimizer."""

    def __init__(self, texts: pa.Array, window: int):
        k = min(window, max(2, window * 5 // 8))  # long enough that texts rarely share one by chance
        h, self.n_words = word_hashes(texts, lower=False)
        self.hashes = h
        self.first_word = np.cumsum(self.n_words) - self.n_words
        m = len(h) - k + 1
        x = np.zeros(max(m, 0), np.uint64)
        for i in range(k if m > 0 else 0):
            x = mix(x + h[i:i + m] + np.uint64(i + 1))
        n = max(len(h) - window + 1, 0)
        best, where = x[:n].copy(), np.zeros(n, np.int32)
        for i in range(1, window - k + 1):
            less = x[i:i + n] < best
            np.copyto(best, x[i:i + n], where=less)
            where[less] = i
        starts = np.arange(n)
        count = np.maximum(self.n_words - window + 1, 0)
        doc = np.repeat(np.arange(len(self.n_words)), count)
        keep = self.first_word[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        place = (starts + where)[keep]
        new = np.ones(len(keep), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        #: Of each run: its document, first window (a word position in the slice), number of windows, minimizer.
        self.doc, self.first = doc[at], keep[at]
        self.windows = np.diff(np.append(at, len(keep)))
        self.minimizer = best[keep[at]] if n else best
        self.place = place[at]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("doc"), docs["text"].cast("string").alias("text")).withColumns({"key": F.xxhash64("text"), "more": F.xxhash64(F.lit(1), "text")})


def _narrow(a: np.ndarray) -> bytes:
    """Numbers from 0 in one, two or four bytes each."""
    top = int(a.max(initial=0))
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32).tobytes()


def _wide(b: bytes, n: int) -> np.ndarray:
    return np.frombuffer(b, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(b) // n] if n else np.uint8).astype(np.int64)


def _steps(a: np.ndarray) -> bytes:
    """Ascending numbers as their differences."""
    return _narrow(np.diff(a, prepend=0))


def _sums(b: bytes, n: int) -> np.ndarray:
    return np.cumsum(_wide(b, n))


def _marks(*columns: np.ndarray) -> np.ndarray:
    """Where some column differs from the row before (the first row included)."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _packed(rows: list[tuple], to: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int32(), *PACK_TYPES])], [to, *PACK_NAMES])


def _answer_table(rows: list[tuple]) -> pa.Table:
    return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(PACK_NAMES, PACK_TYPES, strict=True))})


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of texts and a number for each, unique over tasks."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for b in batches:
        for i, j in slices(b["text"], SLICE):
            yield number, b.slice(i, j - i)
            number += 1


def _bytes(c: pa.Array) -> bytes:
    return c.to_numpy().tobytes()


def _asks(rows: DataFrame, window: int, buckets: int) -> DataFrame:
    """To buckets: docs and a (word place) of the first document of the slice with a minimizer, b (five bytes of it), c (its documents).

    The slice's own row has its documents' id, key and second hash in docs, a and e, and in b, c and d the documents,
    places and starts of groups of the minimizers that several of them have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, b in _numbered(batches):
            runs = Runs(b["text"], window)
            place = runs.place - runs.first_word[runs.doc]
            order = np.lexsort((runs.doc, runs.minimizer))
            h, d, p = runs.minimizer[order], runs.doc[order], place[order]
            one = _marks(h, d)  # a document's first place of each
            h, d, p = h[one], d[one], p[one]
            begin = np.flatnonzero(_marks(h)) if len(h) else np.zeros(0, np.int64)
            count = np.diff(np.append(begin, len(h)))
            many = np.repeat(count > 1, count)
            out = [(number % buckets, number, -b.num_rows, _bytes(b["doc"]), _bytes(b["key"]), d[many].astype(np.uint32).tobytes(), p[many].astype(np.uint32).tobytes(), np.packbits(_marks(h[many])).tobytes() if many.any() else b"", _bytes(b["more"]))]
            h, d, p = h[begin], d[begin], p[begin]
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            turn = np.lexsort((d, bucket))
            edges = np.searchsorted(bucket[turn], np.arange(buckets + 1)).tolist()
            raw = h.view(np.uint8).reshape(-1, 8)[:, 3:]  # the low bits gave the bucket; 40 more only say where to look again
            for q, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if t := turn[x:y].tolist():
                    out.append((q, number, len(t), _steps(d[t]), _narrow(p[t]), raw[t].tobytes(), _narrow(count[t]), None, None))
            yield _packed(out, "bucket")

    return rows.select("doc", "key", "more", "text").mapInArrow(run, "bucket int, " + PACK)


def _answers(asked: DataFrame, hot_docs: int) -> DataFrame:
    """Entries whose minimizer several documents have, in a slice or over slices: docs, a (places), b (1 for a hot one). Rows of slices pass."""

    def run(group: pa.Table) -> pa.Table:
        rows = [r for r in zip(*(group[c].to_pylist() for c in PACK_NAMES), strict=True)]
        out, asks = [r for r in rows if r[1] < 0], [r for r in rows if r[1] > 0]
        if asks:
            n = [r[1] for r in asks]
            raw = np.zeros((sum(n), 8), np.uint8)
            raw[:, 3:] = np.frombuffer(b"".join([r[4] for r in asks]), np.uint8).reshape(-1, 5)
            h = raw.view(np.uint64).ravel()
            count = np.concatenate([_wide(r[5], r[1]) for r in asks])
            order = np.argsort(h, kind="stable")
            begin = np.flatnonzero(_marks(h[order]))
            group_of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(h))))
            docs = np.empty(len(h), np.int64)
            docs[order] = np.add.reduceat(count[order], begin)[group_of]
            end = 0
            for number, k, d, a, *_ in asks:
                mine = docs[end:end + k]
                hot, has = mine > hot_docs, mine > 1
                end += k
                if has.any():
                    out.append((number, int(has.sum()), _steps(_sums(d, k)[has]), _narrow(_wide(a, k)[has]), _narrow(hot[has].astype(np.int64)), None, None, None))
        return _answer_table(out)

    return asked.groupBy("bucket").applyInArrow(run, PACK)


def _flags(answered: DataFrame) -> DataFrame:
    """Per document: doc, key, more, places (of minimizers that others have), hot (which of them very many have)."""

    def run(group: pa.Table) -> pa.Table:
        rows = [r for r in zip(*(group[c].to_pylist() for c in PACK_NAMES), strict=True)]
        own = next(r for r in rows if r[1] < 0)
        n, got = -own[1], [r for r in rows if r[1] > 0]
        docs = np.concatenate([np.zeros(0, np.int64), *(_sums(r[2], r[1]) for r in got)])
        places = np.concatenate([np.zeros(0, np.int64), *(_wide(r[3], r[1]) for r in got)])
        hot = np.concatenate([np.zeros(0, np.int64), *(_wide(r[4], r[1]) for r in got)])
        d, p = np.frombuffer(own[4], np.uint32).astype(np.int64), np.frombuffer(own[5], np.uint32).astype(np.int64)
        if len(d):  # the other documents of groups are as hot as the first, which was answered
            new = np.unpackbits(np.frombuffer(own[6], np.uint8), count=len(d)).astype(bool)
            heat = np.isin(d[new] << 32 | p[new], (docs << 32 | places)[hot > 0])[np.cumsum(new) - 1]
            docs, places, hot = np.concatenate([docs, d[~new]]), np.concatenate([places, p[~new]]), np.concatenate([hot, heat[~new]])
        order = np.argsort(docs, kind="stable")
        docs, places, hot = docs[order], places[order].astype(np.uint32), hot[order].astype(np.uint8)
        edges = np.searchsorted(docs, np.arange(n + 1)).tolist()
        spans = list(zip(edges[:-1], edges[1:], strict=True))
        return pa.table({
            "doc": pa.array(np.frombuffer(own[2], np.int64)), "key": pa.array(np.frombuffer(own[3], np.int64)), "more": pa.array(np.frombuffer(own[7], np.int64)),
            "places": pa.array([_narrow(places[x:y]) for x, y in spans], pa.binary()), "hot": pa.array([hot[x:y].tobytes() for x, y in spans], pa.binary()),
        })

    return answered.groupBy("slice").applyInArrow(run, "doc long, key long, more long, places binary, hot binary")


def _segments(flagged: DataFrame, window: int, shards: int) -> DataFrame:
    """To shards: n segments; docs (their numbers in the slice), a (their text, compressed), b and c (smallest and largest doc_id).

    The slice's own row has its documents' id and key in docs and a, in b, c and d the document, first word and segment of all places, their number in e."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1).compress
        for number, b in _numbered(batches):
            runs = Runs(b["text"], window)
            hots = [np.frombuffer(x, np.uint8) for x in b["hot"].to_pylist()]
            named = [_wide(x, len(h)) for x, h in zip(b["places"].to_pylist(), hots, strict=True)]
            place = np.concatenate(named) + np.repeat(runs.first_word, list(map(len, named)))
            # the same minimizer elsewhere in the document is meant as well
            code = np.unique(runs.minimizer, return_inverse=True)[1]
            pair = runs.doc.astype(np.int64) << 32 | code
            hit = np.isin(pair, pair[np.isin(runs.place, place)])
            burning = np.isin(runs.minimizer, runs.minimizer[np.isin(runs.place, place[np.concatenate(hots) > 0])]) & hit
            doc, first, count, to = runs.doc[hit], runs.first[hit], runs.windows[hit], runs.minimizer[hit]
            if burning.any():
                cool, c = ~burning[hit], runs.windows[burning]
                single = np.repeat(runs.first[burning], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
                x = np.zeros(len(single), np.uint64)
                for i in range(window):
                    x = mix(x + runs.hashes[single + i] + np.uint64(i + 1))
                doc, first = np.concatenate([doc[cool], np.repeat(runs.doc[burning], c)]), np.concatenate([first[cool], single])
                count, to = np.concatenate([count[cool], np.ones(len(single), np.int64)]), np.concatenate([to[cool], x])
                order = np.argsort(first, kind="stable")
                doc, first, count, to = doc[order], first[order], count[order], to[order]
            words = [w for t in b["text"].to_pylist() for w in (t or "").encode().split()]
            seen: dict[bytes, int] = {}
            which = np.fromiter((seen.setdefault(b" ".join(words[f:e]), len(seen)) for f, e in zip(first.tolist(), (first + count + window - 1).tolist(), strict=True)), np.int64, len(first))
            texts = list(seen)
            ids = b["doc"].to_numpy()[doc]
            low, high = np.full(len(texts), LAST), np.zeros(len(texts), np.int64) - LAST
            np.minimum.at(low, which, ids)
            np.maximum.at(high, which, ids)
            shard = np.zeros(len(texts), np.int64)
            shard[which] = (to % np.uint64(shards)).astype(np.int64)
            turn = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[turn], np.arange(shards + 1)).tolist()
            out = [(number % shards, number, -b.num_rows, _bytes(b["doc"]), _bytes(b["key"]), _steps(doc), _narrow(first - runs.first_word[doc]), _narrow(which), len(doc).to_bytes(8, "little"))]
            for q, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if t := turn[x:y].tolist():
                    out.append((q, number, len(t), _steps(turn[x:y]), press(b"\n".join([texts[i] for i in t])), low[t].tobytes(), high[t].tobytes(), None, None))
            yield _packed(out, "shard")

    return flagged.select("doc", "key", "text", "places", "hot").mapInArrow(cut, "shard int, " + PACK)


def _searched(segments: DataFrame, window: int) -> DataFrame:
    """Segments with a window that a smaller document has than the slice's largest: docs (numbers), a (stretches of windows
    with one smallest document in each), b (windows of each stretch), c (that document). Rows of slices pass."""

    def search(group: pa.Table) -> pa.Table:
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        rows = [r for r in zip(*(group[c].to_pylist() for c in PACK_NAMES), strict=True)]
        out, sent = [r for r in rows if r[1] < 0], [r for r in rows if r[1] > 0]
        if sent:
            lists = pc.split_pattern(pa.array([unpress(r[3]) for r in sent], pa.large_binary()).cast(pa.large_string()), "\n")
            coded = lists.flatten().dictionary_encode()
            segment = coded.indices.to_numpy().astype(np.int64)
            low, high = (np.frombuffer(b"".join([r[i] for r in sent]), np.int64) for i in (4, 5))
            owner = np.full(len(coded.dictionary), LAST)
            np.minimum.at(owner, segment, low)
            parts = pc.split_pattern(coded.dictionary, " ")
            words = parts.flatten().dictionary_encode()
            sizes = np.diff(parts.offsets.to_numpy()).astype(np.int64)
            least, count = earliest((words.indices.to_numpy().astype(np.int64) + 1, sizes), owner, window)
            begin = np.cumsum(count) - count
            # stretches of windows with one smallest document
            new = np.ones(len(least), bool)
            new[1:] = least[1:] != least[:-1]
            new[begin] = True
            start = np.flatnonzero(new)
            value, length = least[start], np.diff(np.append(start, len(least)))
            per = np.add.reduceat(new.astype(np.int64), begin)
            at = np.cumsum(per) - per
            lowest = np.minimum.reduceat(least, begin)
            end = 0
            for number, n, d, *_ in sent:
                mine = segment[end:end + n]
                use = lowest[mine] < high[end:end + n]
                end += n
                if use.any():
                    mine = mine[use]
                    k = per[mine]
                    x = np.repeat(at[mine] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
                    out.append((number, len(mine), _steps(_sums(d, n)[use]), _narrow(k), _narrow(length[x]), value[x].tobytes(), None, None))
        return _answer_table(out)

    return segments.groupBy("shard").applyInArrow(search, PACK)


def _intervals(searched: DataFrame, window: int) -> DataFrame:
    """Per document with covered words: doc, key, starts and lengths (words, four bytes each)."""

    def run(group: pa.Table) -> pa.Table:
        rows = [r for r in zip(*(group[c].to_pylist() for c in PACK_NAMES), strict=True)]
        own = next(r for r in rows if r[1] < 0)
        got, ids = [r for r in rows if r[1] > 0], np.frombuffer(own[2], np.int64)
        keys, total = np.frombuffer(own[3], np.int64), int.from_bytes(own[7], "little")
        none = pa.table({"doc": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "starts": pa.array([], pa.binary()), "lengths": pa.array([], pa.binary())})
        if not got:
            return none
        doc, first, which = _sums(own[4], total), _wide(own[5], total), _wide(own[6], total)
        number = np.concatenate([_sums(r[2], r[1]) for r in got])
        per = np.concatenate([_wide(r[3], r[1]) for r in got])
        length = np.concatenate([_wide(r[4], len(r[5]) // 8) for r in got])
        value = np.frombuffer(b"".join([r[5] for r in got]), np.int64)
        slot = np.full(int(max(which.max(initial=0), number.max())) + 1, -1)
        slot[number] = np.arange(len(number))
        hit = slot[which] >= 0
        doc, first, at = doc[hit], first[hit], slot[which[hit]]
        k, base = per[at], (np.cumsum(per) - per)[at]
        x = np.repeat(base - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
        before = np.cumsum(length) - length
        offset = before[x] - np.repeat(before[base], k)
        doc, start, n = np.repeat(doc, k), np.repeat(first, k) + offset, length[x] + window - 1
        gone = value[x] < ids[doc]
        doc, start, n = doc[gone], start[gone], n[gone]
        edges = np.flatnonzero(_marks(doc)) if len(doc) else np.zeros(0, np.int64)
        spans = list(zip(edges.tolist(), [*edges[1:].tolist(), len(doc)], strict=True)) if len(doc) else []
        start, n = start.astype(np.uint32), n.astype(np.uint32)
        at = doc[edges]
        return pa.table({"doc": pa.array(ids[at]), "key": pa.array(keys[at]), "starts": pa.array([start[a:e].tobytes() for a, e in spans], pa.binary()), "lengths": pa.array([n[a:e].tobytes() for a, e in spans], pa.binary())})

    return searched.groupBy("slice").applyInArrow(run, "doc long, key long, starts binary, lengths binary")


def _joined(rows: DataFrame, small: DataFrame, payload: list[str], most_bytes: int) -> DataFrame:
    """rows left-joined to `small` on doc and key; sent to every task only if it's small enough."""
    size = small.agg(F.coalesce(F.sum(sum((F.octet_length(c) for c in payload), F.lit(64))), F.lit(0))).head()[0]
    return rows.join(F.broadcast(small) if size <= most_bytes else small, ["doc", "key"], "left")


def dedup(docs: DataFrame, window: int = 13, hot_docs: int = 20_000, most_broadcast_bytes: int = 64_000_000, bucket_bytes: int = 48_000_000, shard_bytes: int = 24_000_000) -> DataFrame:
    """Adds n_words, n_removed and kept_text (kept words joined by one space; null text: empty) to docs.

    bucket_bytes and shard_bytes: text per bucket and shard, about; their numbers follow the corpus."""
    spark = docs.sparkSession
    rows = _rows(bounded_batches(docs))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    buckets, shards = (max(ranges_for(spark), -(-size // x)) for x in (bucket_bytes, shard_bytes))
    answered = _answers(_asks(rows, window, buckets).repartition(buckets, "bucket"), hot_docs)
    flags = stored(_flags(answered).groupBy("doc", "key", "more").agg(F.first("places").alias("places"), F.first("hot").alias("hot")))
    # texts that an earlier document has whole need no search
    first = flags.groupBy("key", "more").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "more", "first")
    first = stored(first)
    few = first.count() * 64 <= most_broadcast_bytes
    copies = stored(flags.select("doc", "key", "more").join(F.broadcast(first) if few else first, ["key", "more"]).where("first < doc").select("doc", "key"))
    wanted = flags.where(F.octet_length("places") > 0).drop("more").join(copies, ["doc", "key"], "left_anti")
    cut = _segments(_joined(rows, wanted, ["places", "hot"], most_broadcast_bytes).where("places is not null"), window, shards)
    found = _intervals(_searched(cut.repartition(shards, "shard"), window), window)
    gone = found.dropDuplicates(["doc", "key"]).withColumn("copy", F.lit(False)).unionByName(copies.withColumns({"starts": F.lit(None).cast("binary"), "lengths": F.lit(None).cast("binary"), "copy": F.lit(True)}))
    gone = stored(gone)

    kept = docs.drop("n_words", "n_removed", "kept_text")
    held = kept.select(F.struct("*").alias("row"))  # other columns may have any names
    keyed = held.select("row", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(F.col("row.text").cast("string")).alias("key"))
    whole = _joined(keyed, gone, ["starts", "lengths"], most_broadcast_bytes).select("row", "starts", "lengths", "copy")
    names = kept.columns
    schema = kept.schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, texts = [], [], []
            cols = dict(zip(names, b["row"].flatten(), strict=True))
            for text, starts, lengths, copy in zip(cols["text"].cast(pa.large_string()).to_pylist(), b["starts"].to_pylist(), b["lengths"].to_pylist(), b["copy"].to_pylist(), strict=True):
                words = (text or "").encode().split()
                n.append(len(words))
                if copy and len(words) >= window:
                    removed.append(len(words))
                    words = []
                elif starts:
                    step = np.zeros(len(words) + 1, np.int64)
                    at = np.frombuffer(starts, np.uint32).astype(np.int64)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + np.frombuffer(lengths, np.uint32), -1)
                    left = np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()
                    removed.append(len(words) - len(left))
                    words = [words[k] for k in left]
                else:
                    removed.append(0)
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], [*names, "n_words", "n_removed", "kept_text"])

    return whole.mapInArrow(take_out, schema)


#: The same rows by all windows (13 words), for small tables (unique doc_ids).
SQL = r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
    f AS (SELECT s, min(doc_id) AS first FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)),
    g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM s JOIN f USING (s) WHERE doc_id > first),
    a AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM w),
    t AS (SELECT a.doc_id, string_agg(x, ' ' ORDER BY k) AS kept FROM a ANTI JOIN g ON g.doc_id = a.doc_id AND g.k = a.k GROUP BY a.doc_id),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""
