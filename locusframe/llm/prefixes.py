"""Prefix trie of conversations by vertical bitmaps.

Conversations are put together by conv_id and dealt into shards of neighbouring ids. In a shard every (position,
turn) has a bitmap of the conversations that have this turn there. Depth first, a node's bitmap is intersected
with the postings of the position behind it: the posting of the first conversation left gives a child, whose members
are then taken out, so there is one intersection per child. What reaches no further ends at the node. Popcounts give
the members; nodes are numbered in the order of the walk, so that a subtree is a run of numbers.

Nodes of different shards are one if the digests of their turns, chained from the root, agree (128 bits of SHA-256).
Each node is owned by the shard of its smallest member. Sums over subtrees come from two additive parts: members times
bytes over the shards' own subtrees, less each distinct node's bytes, which its owner counts once. So no round per
depth is needed. A row per shard and node travels, never a node's members; a node's ending ids go to its
checksum in shard order as text, streamed through one task, since SHA-256 is one chain.

Turns are in order of turn (null first), then role, then text; null role or text is empty. Rows with a null conv_id
belong to no conversation. Repeated rows are turns of their own. A table without conversations has no nodes.
Texts of any length are digested before turns are put together; a shard holds 24 bytes per turn of at
most `most_convs` conversations, or of one longer than `most_turns`. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.shared import bounded_batches, ranges_for, stored

ROOT = b"\0" * 16
NODE = pa.schema(
    [("shard", pa.int64()), ("number", pa.int64()), ("up", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("weight", pa.int64()), ("leaf", pa.bool_()), ("ends", pa.string())]
)
NODE_SQL = "shard long, number long, up long, depth long, node binary, first long, n long, bytes long, weight long, leaf boolean, ends string"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest (16 bytes), bytes: turns in order, without their texts."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    digest = F.unhex(F.left(F.sha2(F.concat_ws("\0", F.octet_length("role").cast("string"), "role", "text"), 256), F.lit(32)))
    return rows.select("conv_id", place.cast("long").alias("place"), digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes"))


def shared_openings(turns: DataFrame, length: Column, of: int) -> DataFrame:
    """Every conversation c anew: the first `length` (of conv_id, below 9) turns of conversation c - c % of, then its own behind as many.

    Columns: conv_id, part (0: there is such a conversation, 1: opening, 2: its own), place, digest, bytes."""
    base = F.col("conv_id")
    near = F.filter(F.sequence(base - (of - 1), base + (of - 1)), lambda c: c - c % of == base)
    openings = turns.where((base % of == 0) & (F.col("place") <= 8)).withColumn("conv_id", F.explode(near)).where(F.col("place") <= length)
    there = turns.where("place = 1").select("conv_id")
    openings = openings.join(there, "conv_id", "left_semi").select("conv_id", F.lit(1).alias("part"), "place", "digest", "bytes")
    mark = there.select("conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    own = turns.where(F.col("place") > length).select("conv_id", F.lit(2).alias("part"), "place", "digest", "bytes")
    return mark.union(openings).union(own)


def as_they_are(turns: DataFrame) -> DataFrame:
    """Conversations unchanged, in the form that `trie` takes."""
    return shared_openings(turns, F.lit(0), 1)


class Shard:
    """Conversations by ascending id, and their bitmaps by position and turn."""

    def __init__(self, ids: list[int], turns: list[list[tuple[bytes, int]]]):
        self.ids, self.turns = ids, turns
        self.postings: dict[tuple[int, bytes], int] = {}
        self.longer: list[int] = []
        for c, row in enumerate(turns):
            bit = 1 << c
            self.longer += [0] * (len(row) - len(self.longer))
            for at, (turn, _) in enumerate(row):
                self.postings[at, turn] = self.postings.get((at, turn), 0) | bit
                self.longer[at] |= bit

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield self.ids[low.bit_length() - 1]
            bits ^= low

    def nodes(self) -> pa.Table:
        """All nodes in the order of a depth-first walk, with the sum of members times bytes over each one's subtree."""
        number, shard = 0, self.ids[0]
        up, depth, key, first, count, size, ends = [], [], [], [], [], [], []
        todo = [((1 << len(self.ids)) - 1, -1, 0, ROOT, 0)]
        while todo:
            bits, parent, d, name, b = todo.pop()
            lowest = (bits & -bits).bit_length() - 1
            further = bits & self.longer[d] if d < len(self.longer) else 0
            over = bits ^ further
            up.append(parent)
            depth.append(d)
            key.append(name)
            first.append(self.ids[lowest])
            count.append(bits.bit_count())
            size.append(b)
            ends.append(",".join(map(str, self.members(over))) if over else None)
            while further:
                turn, b = self.turns[(further & -further).bit_length() - 1][d]
                child = bits & self.postings[d, turn]
                further &= ~child
                todo.append((child, number, d + 1, hashlib.sha256(name + turn).digest()[:16], b))
            number += 1
        up, n, size = np.array(up), np.array(count), np.array(size)
        last = np.arange(number)
        for i in range(number - 1, 0, -1):
            if last[i] > last[up[i]]:
                last[up[i]] = last[i]
        upto = np.concatenate([[0], np.cumsum(n * size)])
        cols = [np.full(number, shard), np.arange(number), up, np.array(depth)]
        return pa.table([*map(pa.array, cols), pa.array(key, pa.binary()), pa.array(first), pa.array(n), pa.array(size), pa.array(upto[last + 1] - upto[:-1]), pa.array(last == np.arange(number)), pa.array(ends, pa.string())], schema=NODE)


def _shards(rebuilt: DataFrame, most_convs: int, most_turns: int) -> DataFrame:
    """The nodes of every shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        turns: list[list[tuple[bytes, int]]] = []
        held = 0
        for b in batches:
            for c, part, turn, size in zip(*(b[x].to_pylist() for x in ("conv_id", "part", "digest", "bytes")), strict=True):
                if not part:
                    if len(ids) >= most_convs or held >= most_turns:
                        yield from Shard(ids, turns).nodes().to_batches(max_chunksize=20_000)
                        ids, turns, held = [], [], 0
                    ids.append(c)
                    turns.append([])
                else:
                    turns[-1].append((turn, size))
                    held += 1
        if ids:
            yield from Shard(ids, turns).nodes().to_batches(max_chunksize=20_000)

    ordered = rebuilt.repartitionByRange(ranges_for(rebuilt.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part", "place")
    return stored(ordered.mapInArrow(run, NODE_SQL))


def _owned(local: DataFrame) -> DataFrame:
    """Per shard and node what the shard owns below it: leaves, bytes and children; and its parent's conv_id."""
    schema = pa.schema([("node", pa.binary()), ("parent_conv_id", pa.int64()), ("leaves", pa.int64()), ("owned", pa.int64()), ("children", pa.int64())])

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by("number")
        up, conv, own = t["up"].to_numpy(), t["conv_id"].to_numpy(), t["first"].to_numpy() == t["conv_id"].to_numpy()
        n = len(up)
        last = np.arange(n)
        for i in range(n - 1, 0, -1):
            if last[i] > last[up[i]]:
                last[up[i]] = last[i]
        sums = []
        for x in (own & t["leaf"].to_numpy(zero_copy_only=False), np.where(own, t["bytes"].to_numpy(), 0)):
            upto = np.concatenate([[0], np.cumsum(x.astype(np.int64))])
            sums.append(upto[last + 1] - upto[:-1])
        children = np.bincount(up[own & (up >= 0)], minlength=n)
        return pa.table([t["node"], pa.array(np.where(up < 0, 0, conv[up]), mask=up < 0), *map(pa.array, sums), pa.array(children)], schema=schema)

    return local.groupBy("shard").applyInArrow(run, "node binary, parent_conv_id long, leaves long, owned long, children long")


def _checksums(local: DataFrame) -> DataFrame:
    """The checksum of each node's ending ids: shards follow one another by their smallest id, so their texts join in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, hashlib.sha256()
        for b in batches:
            nodes, sums = [], []
            for node, ids in zip(b["node"].to_pylist(), b["ends"].to_pylist(), strict=True):
                if node != at:
                    if at is not None:
                        nodes.append(at)
                        sums.append(state.hexdigest())
                    at, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sums, pa.string())], ["node", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    ending = local.where("ends is not null").select("node", "shard", "ends")
    return ending.repartition("node").sortWithinPartitions("node", "shard").mapInArrow(run, "node binary, ends_sha256 string")


def trie(rebuilt: DataFrame, most_convs: int = 2048, most_turns: int = 200_000) -> DataFrame:
    """The nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    local = _shards(bounded_batches(rebuilt), most_convs, most_turns)
    whole = local.groupBy("node").agg(F.min("first").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n").alias("n_convs"), F.sum("weight").alias("weight"), F.bool_and("leaf").alias("leaf"))
    whole = stored(whole)
    known = local.select("shard", "number", "up", "node", "first", "bytes").join(whole.select("node", "conv_id", "leaf"), "node")
    below = _owned(known).groupBy("node").agg(F.min("parent_conv_id").alias("parent_conv_id"), F.sum("leaves").alias("n_leaves"), F.sum("owned").alias("owned"), F.sum("children").alias("n_children"))
    nodes = whole.join(below, "node").join(_checksums(local), "node", "left")
    empty = hashlib.sha256().hexdigest()
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("weight") - F.col("owned")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


SQL = """
    WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
      FROM conversations WHERE conv_id IS NOT NULL),
    bits AS (SELECT unnest(range(256))::BIGINT AS i), table_ AS (SELECT list(x ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS x FROM bits)),
    c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda y: ascii(y)::BIGINT)), lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM t), table_),
    r AS (SELECT c.conv_id, 0 AS part, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND place <= h
      UNION ALL SELECT c.conv_id, 1, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place > h),
    o AS (SELECT conv_id, row_number() OVER w AS depth, list([role, text]) OVER w AS turns, strlen(text) AS bytes FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
    p AS (SELECT conv_id, 0 AS depth, []::VARCHAR[][] AS turns, 0 AS bytes FROM c UNION ALL SELECT * FROM o),
    n AS (SELECT depth, turns, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY depth, turns),
    q AS (SELECT p.conv_id AS member, p.depth, n.conv_id, max(p.depth) OVER (PARTITION BY p.conv_id) AS top FROM p JOIN n USING (depth, turns)),
    s AS (SELECT DISTINCT a.conv_id, a.depth, b.conv_id AS parent FROM q a JOIN q b ON b.member = a.member AND b.depth = a.depth - 1),
    k AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n FROM s GROUP BY ALL),
    e AS (SELECT conv_id, depth, sha256(string_agg(member::VARCHAR, ',' ORDER BY member)) AS ends FROM q WHERE depth = top GROUP BY ALL),
    u AS (SELECT a.conv_id, a.depth, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved, count_if(k.n IS NULL) AS leaves
      FROM n LEFT JOIN k USING (conv_id, depth) JOIN q a ON a.member = n.conv_id AND a.depth <= n.depth GROUP BY ALL)
    SELECT n.conv_id, n.depth::BIGINT AS depth, s.parent AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, u.leaves::BIGINT AS n_leaves, u.saved AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
    FROM n LEFT JOIN s USING (conv_id, depth) LEFT JOIN k USING (conv_id, depth) LEFT JOIN e USING (conv_id, depth) JOIN u USING (conv_id, depth)"""
