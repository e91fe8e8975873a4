"""Byte-level BPE encoding and decoding by recursive DuckDB queries, one database per Python worker.

Every match of the pre-token pattern becomes token-position rows that start as single bytes.
A recursive query joins neighbouring rows with the merge table, contracts each piece's leftmost
pair of least rank, and goes on with the pieces that changed until none does. Decoding joins
ids with the vocabulary and aggregates in order of position.

A recursive query's result holds the rows of all rounds, of which there are as many as merges. Pieces
of over LONG bytes go through the same contraction with keyed recursion, which holds a row per
token and passes on only the rows that changed.

A match that is a token itself needs no contraction: its id is its rank, as with the tiktoken library. Of equal ranks
the leftmost pair contracts first.

Nulls and empty texts give no ids; an empty table gives no rows. Texts of any length are encoded
whole, in slices of an Arrow batch. Rows with equal or null keys are kept as they are. The result has
doc_id and the named columns alone; other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from locusframe.llm.shared import bounded_batches
from locusframe.llm.wordcache import ChunkEncoder, gather, slices

LONG = 64

#: Rows (piece, position, token, next position, next token); a piece leaves once no pair of it merges.
#: The least rank, its position and the one behind it travel in one number.
CONTRACT = """
WITH RECURSIVE step(round, piece, pos, tok, npos, ntok) AS (
  SELECT 0, piece, pos, tok, pos + 1, lead(tok) OVER (PARTITION BY piece ORDER BY pos) FROM start
  UNION ALL
  (WITH best AS (
     SELECT s.piece, max(s.round) + 1 AS round, min(g.merged * 17592186044416 + s.pos::BIGINT * 4194304 + s.npos) AS b
     FROM step s JOIN merges g ON g.pair = s.tok::BIGINT * 16777216 + s.ntok GROUP BY s.piece),
   spot AS (
     SELECT b.round, b.piece, (b.b >> 44)::INT AS merged, ((b.b >> 22) & 4194303)::INT AS pos, r.pos AS gone, r.npos, r.ntok
     FROM best b JOIN step r ON r.piece = b.piece AND r.pos = (b.b & 4194303)::INT)
   SELECT t.round, s.piece, s.pos,
     CASE WHEN s.pos = t.pos THEN t.merged ELSE s.tok END,
     CASE WHEN s.pos = t.pos THEN t.npos ELSE s.npos END,
     CASE WHEN s.pos = t.pos THEN t.ntok WHEN s.npos = t.pos THEN t.merged ELSE s.ntok END
   FROM step s JOIN spot t USING (piece) WHERE s.pos <> t.gone))
SELECT s.piece, list(tok ORDER BY pos) AS ids
FROM step s JOIN (SELECT piece, max(round) AS round FROM step GROUP BY piece) l ON s.piece = l.piece AND s.round = l.round
GROUP BY s.piece ORDER BY s.piece
"""

#: The same with one row per position, which keeps its pair's rank: a round passes on the rows that contractions change, and only they look
#: ranks up; token -1 marks what is gone. Where no pair with the merged token ranks below it (`safe`), the leftmost contraction leaves all
#: other pairs of the least rank as the least, so that these, every other one where they overlap, contract in the same round.
CONTRACT_LONG = """
WITH RECURSIVE step(piece, pos, tok, npos, ntok, b) USING KEY (piece, pos) AS (
  SELECT s.*, g.merged
  FROM (SELECT piece, pos, tok, pos + 1 AS npos, lead(tok) OVER (PARTITION BY piece ORDER BY pos) AS ntok FROM start) s
  LEFT JOIN merges g ON g.pair = s.tok::BIGINT * 16777216 + s.ntok
  UNION
  (WITH best AS (SELECT piece, min(b) AS b FROM recurring.step WHERE piece IN (SELECT piece FROM step) GROUP BY piece HAVING min(b) IS NOT NULL),
   hit AS (SELECT s.piece, s.pos, s.npos, s.b, lag(s.npos) OVER w IS DISTINCT FROM s.pos AS apart, row_number() OVER w AS n FROM recurring.step s JOIN best ON best.piece = s.piece AND best.b = s.b WINDOW w AS (PARTITION BY s.piece ORDER BY s.pos)),
   run AS (SELECT *, n - max(CASE WHEN apart THEN n END) OVER (PARTITION BY piece ORDER BY n ROWS UNBOUNDED PRECEDING) AS k FROM hit),
   spot AS (SELECT piece, pos, npos AS gone, b AS merged FROM run WHERE k % 2 = 0 AND (n = 1 OR b NOT IN (SELECT tok FROM unsafe))),
   whole AS (SELECT t.*, r.npos, r.ntok FROM spot t JOIN recurring.step r ON r.piece = t.piece AND r.pos = t.gone),
   changed AS (
     SELECT t.piece, t.pos, t.merged AS tok, t.npos, CASE WHEN x.pos IS NULL THEN t.ntok ELSE x.merged END AS ntok FROM whole t LEFT JOIN spot x ON x.piece = t.piece AND x.pos = t.npos
     UNION ALL SELECT piece, gone, -1, -1, NULL FROM spot
     UNION ALL SELECT s.piece, s.pos, s.tok, s.npos, t.merged FROM recurring.step s JOIN spot t ON t.piece = s.piece AND t.pos = s.npos WHERE NOT EXISTS (SELECT 1 FROM spot x WHERE x.piece = s.piece AND x.gone = s.pos))
   SELECT s.*, g.merged FROM changed s LEFT JOIN merges g ON g.pair = s.tok::BIGINT * 16777216 + s.ntok))
SELECT piece, list(tok ORDER BY pos) AS ids FROM step WHERE tok >= 0 GROUP BY piece ORDER BY piece
"""

DECODE = "SELECT doc, array_to_string(list(chars ORDER BY pos), '') AS text FROM ids JOIN vocab USING (tok) GROUP BY doc ORDER BY doc"


class RankBPE:
    """Encodes and decodes by a tiktoken rank file. Bytes stand as the characters of the same number in SQL."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [(ranks[t[:i]] * 16777216 + ranks[t[i:]], m) for t, m in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        # tokens of which a pair makes a token of no higher rank
        unsafe = {t for p, m in pairs for t in (p >> 24, p & 16777215) if m <= t}
        made = pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "merged": pa.array([m for _, m in pairs], pa.int32())})
        words = pa.table({"tok": pa.array(list(ranks.values()), pa.int32()), "chars": [t.decode("latin-1") for t in ranks]})
        for name, t in (("merges", made), ("vocab", words), ("unsafe", pa.table({"tok": pa.array(sorted(unsafe), pa.int32())}))):
            self.db.register("t", t)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM t")
            self.db.unregister("t")

    def pieces(self, parts: list[bytes], block_bytes: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces that are each encoded alone, one after the other, and the number of each."""
        known = [self.ranks.get(p, -1) for p in parts]
        lens = np.ones(len(parts), np.int64)
        flats, at = [np.array([r for r in known if r >= 0], np.uint32)], np.zeros(len(parts), np.int64)
        whole = np.array(known) >= 0
        at[whole] = np.arange(int(whole.sum()))
        done = len(flats[0])
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        for query, chosen in ((CONTRACT, ~whole & (size <= LONG)), (CONTRACT_LONG, ~whole & (size > LONG))):
            rows = np.flatnonzero(chosen)
            for some in np.split(rows, np.flatnonzero(np.diff(np.cumsum(size[rows]) // block_bytes)) + 1) if len(rows) else ():
                n = size[some]
                raw = np.frombuffer(b"".join([parts[i] for i in some.tolist()]), np.uint8)
                pos = np.arange(len(raw)) - np.repeat(np.cumsum(n) - n, n)
                self.db.register("start", pa.table({"piece": pa.array(np.repeat(np.arange(len(some)), n), pa.int32()), "pos": pa.array(pos, pa.int32()), "tok": pa.array(self.of_byte[raw])}))
                ids = self.db.sql(query).to_arrow_table()["ids"].combine_chunks()
                self.db.unregister("start")
                flats.append(ids.flatten().to_numpy().astype(np.uint32))
                lens[some] = np.diff(ids.offsets.to_numpy())
                at[some] = done + np.cumsum(lens[some]) - lens[some]
                done += len(flats[-1])
        return gather(np.concatenate(flats), at, lens), lens

    def encode_parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one after the other, and the number of each; distinct matches of the pattern are encoded once."""
        found = [self.find(t) for t in texts]
        code: dict[str, int] = {}
        which = np.fromiter((code.setdefault(m, len(code)) for f in found for m in f), np.int64)
        flat, n = self.pieces([m.encode("utf-8", "surrogatepass") for m in code])
        first = np.cumsum(n) - n
        per_text = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        sizes = np.concatenate([[0], np.cumsum(n[which])])
        return gather(flat, first[which], n[which]), np.diff(sizes[per_text])

    def decode(self, flat: np.ndarray, n: np.ndarray, block: int = 1_000_000) -> Iterator[bytes]:
        """The bytes of each run of n ids."""
        ends = np.cumsum(n)
        i = 0
        while i < len(n):
            begin = int(ends[i] - n[i])
            j = max(i + 1, int(np.searchsorted(ends, begin + block, "right")))
            doc = np.repeat(np.arange(j - i), n[i:j])
            pos = np.arange(len(doc)) + begin - np.repeat(ends[i:j] - n[i:j], n[i:j])
            self.db.register("ids", pa.table({"doc": pa.array(doc, pa.int32()), "pos": pa.array(pos, pa.int64()), "tok": pa.array(flat[begin:ends[j - 1]].astype(np.int32))}))
            got = self.db.sql(DECODE).to_arrow_table()
            self.db.unregister("ids")
            at = dict(zip(got["doc"].to_pylist(), got["text"].combine_chunks().to_numpy(zero_copy_only=False).tolist() if len(got) else [], strict=True))
            for k in range(j - i):
                yield at.get(k, "").encode("latin-1")
            i = j


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_coders: dict[tuple[str, str], tuple[RankBPE, ChunkEncoder]] = {}


def coder(path: str, pattern: str) -> tuple[RankBPE, ChunkEncoder]:
    """One per Python worker."""
    if (path, pattern) not in _coders:
        bpe = RankBPE(read_ranks(path), pattern)
        _coders[path, pattern] = bpe, ChunkEncoder(bpe.encode_parts, spaced=True)
    return _coders[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, decode: bool = True, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, and decoded_sha256 (if decode) and ids (if with_ids)."""
    schema = "doc_id long, n_tokens long, ids_sha256 string" + ", decoded_sha256 string" * decode + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, chunks = coder(path, pattern)
        for b in batches:
            for i, j in slices(b["text"]):
                flat, n = chunks.encode(b["text"].slice(i, j - i))
                ends = np.cumsum(n)
                cols = [b["doc_id"].slice(i, j - i), pa.array(n), pa.array([hashlib.sha256(flat[e - k:e]).hexdigest() for k, e in zip(n.tolist(), ends.tolist(), strict=True)])]
                if decode:
                    cols.append(pa.array([hashlib.sha256(x).hexdigest() for x in bpe.decode(flat, n)]))
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", *["decoded_sha256"] * decode, *["ids"] * with_ids])

    return bounded_batches(docs).select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, schema)
