"""Near duplicates among embeddings by NN-descent.

Equal vectors are one node from the start. A first neighbour graph comes from sorting the nodes by
random-hyperplane codes, several times over, and comparing each with the next few. Rounds of
NN-descent then join neighbours of neighbours: all nodes around one are compared with each other,
and each node's list keeps the nearest. Edges below `floor` are left out of the graph: two vectors
that are both within the threshold angle of a third are at least that similar. A linked pair with no
other neighbour over `floor` can't be reached by descent, so the orders alone have to find it: their
number follows the table's size, so that a pair at the threshold is missed by all of them with
probability `most_missed` where the other vectors are spread evenly.

A list with `k` entries over the threshold is saturated. The lists of its component are enlarged to
the whole component, which is compared block by block, so that counts are complete without a row
per pair. An audit then compares a bounded sample of queries with all vectors. Recall is taken per
node that has links, and again among nodes with about as many links, so that a large group can't
hide what is missed elsewhere; where links are too rare for a sample, the two halves of the orders are
held against each other. While one of these is below `least_recall`, the search goes on with twice as
many new codes; after `attempts` it fails. The recall of every attempt is logged.

Vectors that are null, zero, or hold null or non-finite components link with nothing, as do vectors
of different lengths. Rows with equal vec_ids are vectors of their own; a null vec_id is never a
component's smallest. Cosines are taken in double precision. An empty table gives no rows. The result has
the named columns alone; other columns of vectors, whatever their names, are not read.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusframe.llm.components import components
from locusframe.llm.shared import ranges_for, stored

log = logging.getLogger(__name__)
EDGE = "a long, b long, sim double"


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Unit rows in double precision."""
    m = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
    # a power of two first, so that squares neither overflow nor vanish
    m = m / 2.0 ** np.floor(np.log2(np.abs(m).max(1, keepdims=True))) if len(m) else m
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def orders(nodes: int, threshold: float, reach: int, most_missed: float = 0.003) -> int:
    """How many orders a pair at the threshold needs to stand within reach in one of them, but for `most_missed`.

    One does if its first bits agree, as many as part the others down to what reach covers."""
    bits = max(0.0, math.log2(max(nodes, 1) / (0.7 * reach)))
    near = (1 - math.acos(min(max(threshold, -1.0), 1.0)) / math.pi) ** bits
    return 1 if near > 1 - most_missed else math.ceil(math.log(most_missed) / math.log1p(-near))


def _neighbours_by_code(nodes: DataFrame, dim: int, trees: int, bits: int, seed: int, reach: int, floor: float) -> DataFrame:
    """Edges between nodes that stand close in one of the orders by random codes; half says in which half of the orders (1, 2)."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).normal(size=(trees, dim, bits + 1))
        for b in batches:
            v = matrix(b["vec"], dim)
            for t in range(trees):
                p = v @ planes[t]
                key = ((p[:, :bits] > 0) * (1 << np.arange(bits - 1, -1, -1))).sum(1) * (1 << 20) + (np.clip(p[:, bits], -1, 1) * 500_000 + 500_000).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(key), b["node"], b["vec"]], ["tree", "key", "node", "vec"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, node, m = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, dim))
        for b in batches:
            old = len(node)
            tree, node = np.concatenate([tree, b["tree"].to_numpy()]), np.concatenate([node, b["node"].to_numpy()])
            m = np.concatenate([m, matrix(b["vec"], dim)])
            for o in range(1, min(reach, len(node) - 1) + 1):
                begin = max(0, old - o)
                x, y = slice(begin, len(node) - o), slice(begin + o, len(node))
                sim = (m[x] * m[y]).sum(1)
                keep = (sim >= floor) & (tree[x] == tree[y])
                yield pa.RecordBatch.from_arrays([pa.array(node[x][keep]), pa.array(node[y][keep]), pa.array(sim[keep]), pa.array(1 + tree[x][keep] % 2)], ["a", "b", "sim", "half"])
            tree, node, m = tree[-reach:], node[-reach:], m[-reach:]

    coded = nodes.select("node", "vec").mapInArrow(code, "tree int, key long, node long, vec array<double>")
    parts = ranges_for(nodes.sparkSession)
    ordered = coded.repartitionByRange(parts, "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    return ordered.mapInArrow(near, EDGE + ", half int")


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """Each node's k nearest, from edges in any direction: node, other, sim."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"), "sim").union(edges.select("b", "a", "sim"))
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    once = both.groupBy("node", "other").agg(F.max("sim").alias("sim"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def _around(lists: DataFrame, nodes: DataFrame, dim: int, k: int, floor: float) -> DataFrame:
    """Edges among the nodes that are listed by, or list, one node (2k of them at most, the nearest)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_hub, held, rows = None, np.zeros(0, np.int64), np.zeros((0, dim))
        for b in batches:
            hub, other, m = b["hub"].to_numpy(), b["node"].to_numpy(), matrix(b["vec"], dim)
            out_a, out_b, out_s = [], [], []
            edges = np.flatnonzero(np.diff(hub, prepend=hub[0] - 1 if len(hub) else 0))
            for begin, end in zip(edges.tolist(), [*edges[1:].tolist(), len(hub)], strict=True):
                if hub[begin] == held_hub:
                    n, x = np.concatenate([held, other[begin:end]]), np.concatenate([rows, m[begin:end]])
                else:
                    n, x = other[begin:end], m[begin:end]
                    held = n[:0]
                s = np.triu(x @ x.T, 1)
                s[:len(held), :len(held)] = 0  # compared with the batch before
                i, j = np.nonzero(s >= floor)
                out_a.append(n[i])
                out_b.append(n[j])
                out_s.append(s[i, j])
                held_hub, held, rows = hub[begin], n, x
            if out_a:
                a, c = np.concatenate(out_a), np.concatenate(out_b)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c)), pa.array(np.concatenate(out_s))], ["a", "b", "sim"])

    near = _nearest(lists.select(F.col("node").alias("a"), F.col("other").alias("b"), "sim"), 2 * k)
    members = near.select(F.col("node").alias("hub"), F.col("other").alias("node")).join(nodes.select("node", "vec"), "node")
    return members.repartition("hub").sortWithinPartitions("hub", "node").mapInArrow(compare, EDGE).where("a <> b").dropDuplicates(["a", "b"])


def _within(members: DataFrame, dim: int, threshold: float, block: int) -> DataFrame:
    """members: component, node, vec, copies. The linked copies of each node (itself left out), over its whole component.

    A component of up to `block` nodes is one block. A larger one has 64 blocks of that size at least, or
    blocks of up to 32 MB of vectors: a vector is sent once for each block, and pairs are counted where blocks meet."""
    most = max(block, (32 << 20) // (8 * dim))
    size = members.groupBy("component").agg(F.count("*").alias("_n"))
    size = size.withColumn("blocks", F.ceil(F.col("_n") / F.least(F.greatest(F.lit(block), F.ceil(F.col("_n") / 64)), F.lit(most))).cast("int")).drop("_n")
    dealt = members.join(size, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns({"low": F.least("own", "with"), "high": F.greatest("own", "with")})

    def count(group: pa.Table) -> pa.Table:
        own, low, high = group["own"].to_numpy(), group["low"][0].as_py(), group["high"][0].as_py()
        node, copies, m = group["node"].to_numpy(), group["copies"].to_numpy(), matrix(group["vec"].combine_chunks(), dim)
        x, y = np.flatnonzero(own == low), np.flatnonzero(own == high)
        of_x, of_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        for i in range(0, len(x), 512):
            some = x[i:i + 512]
            for k in range(0, len(y), 4096):
                rest = y[k:k + 4096]
                linked = m[some] @ m[rest].T >= threshold
                linked &= node[some][:, None] != node[rest]
                of_x[i:i + 512] += linked @ copies[rest]
                if low != high:
                    of_y[k:k + 4096] += copies[some] @ linked
        if low == high:
            return pa.table({"node": pa.array(node[x]), "linked": pa.array(of_x)})
        return pa.table({"node": pa.array(np.concatenate([node[x], node[y]])), "linked": pa.array(np.concatenate([of_x, of_y]))})

    # a block meets its own rows once there, and another block's rows once
    some = pairs.select("component", "low", "high", "own", "node", "copies", "vec")
    return some.groupBy("component", "low", "high").applyInArrow(count, "node long, linked long").groupBy("node").agg(F.sum("linked").alias("linked"))


def _recaptured(seen: DataFrame, threshold: float, enough: int) -> float:
    """Recall of links between nodes with at most two, from how many of those that one half of the orders found the other found too
    (1 if fewer than `enough` / 2 were found: then nothing can be said from the search itself)."""
    links = seen.where(F.col("sim") >= threshold).select("a", "b", "half")
    few = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").count().where(F.col("count") <= 2).select("node")
    rare = links.join(few.withColumnRenamed("node", "a"), "a", "left_semi").join(few.withColumnRenamed("node", "b"), "b", "left_semi")
    row = rare.agg(F.count_if(F.col("half") == 3).alias("both"), F.count_if(F.col("half") >= 2).alias("second")).head()
    return 1 - (1 - row["both"] / row["second"]) ** 2 if row["second"] >= enough / 2 else 1.0


def _audit(nodes: DataFrame, linked: DataFrame, seen: DataFrame, dim: int, threshold: float, queries: int, enough: int = 64) -> float:
    """The least recall of a bounded sample of nodes (smallest hashes): over links, per node, and per node
    among those with 1, 2 to 3, 4 to 7, ... links if at least `enough` / 2 were sampled.

    If fewer than `enough` of the sample have links, 16 times as many are sampled. Where that doesn't show enough either,
    links are rare, and those between nodes with few links are also judged by how often two searches meet (_recaptured)."""
    for n in (queries, 16 * queries):
        sample = nodes.orderBy(F.xxhash64("node")).limit(n).select("node", "vec").collect()
        if not sample:
            return 1.0
        # every sampled node's links, and how many of them were found
        have = _links_of([r["node"] for r in sample], matrix(pa.array([r["vec"] for r in sample]), dim), nodes, dim, threshold)
        rows = have.where("n > 0").join(linked, "node", "left").select("n", F.coalesce("linked", F.lit(0))).collect()
        if len(rows) >= enough or len(sample) < n:
            break
    rare = _recaptured(seen, threshold, enough) if len(rows) < enough and len(sample) == n else 1.0
    if not rows:
        return rare
    n, found = np.array(rows, np.float64).T
    share = np.minimum(n, found) / n
    size = np.floor(np.log2(n))
    groups = [share[size == x] for x in np.unique(size)]
    return float(min([rare, np.minimum(n, found).sum() / n.sum(), share.mean(), *(g.mean() for g in groups if 2 * len(g) >= enough)]))


def _links_of(ids: list[int], q: np.ndarray, nodes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """node, n: how many vectors are linked with each of the queries, by comparison with all."""
    sent, ids = nodes.sparkSession.sparkContext.broadcast(q), np.array(ids)

    def true(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, total = sent.value, np.zeros(len(ids), np.int64)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                hit = q @ matrix(part["vec"], dim).T >= threshold
                hit &= ids[:, None] != part["node"].to_numpy()
                total += hit @ part["copies"].to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["node", "n"])

    return nodes.select("node", "vec", "copies").mapInArrow(true, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def _search(nodes: DataFrame, dim: int, threshold: float, k: int, trees: int, reach: int, rounds: int, block: int, least_recall: float, queries: int, attempts: int) -> tuple[DataFrame, DataFrame]:
    """(node, linked) and (node, component) of nodes with links."""
    floor = 2 * threshold * threshold - 1
    size = nodes.count()
    trees, bits = max(trees, orders(size, threshold, reach)), min(max(16, size.bit_length()), 40)
    found = None
    for attempt in range(attempts):
        seen = _neighbours_by_code(nodes, dim, trees << attempt, bits, 1000 + attempt, reach, floor)
        seen = stored(seen.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sim").alias("sim"), F.bit_or("half").alias("half")))
        fresh = seen.select("a", "b", "sim")
        found = fresh if found is None else stored(found.union(fresh).dropDuplicates(["a", "b"]))
        before = found.count()
        for _ in range(rounds):
            lists = stored(_nearest(found, k))
            found = stored(found.union(_around(lists, nodes, dim, k, floor)).dropDuplicates(["a", "b"]))
            now = found.count()
            if now - before <= 0.001 * before:
                break
            before = now
        links = found.where(F.col("sim") >= threshold).select("a", "b")
        label = stored(components(links))
        listed = links.union(links.select("b", "a")).groupBy("a").count()
        full = listed.where(F.col("count") >= k).join(label, F.col("a") == F.col("node")).select("component").distinct()
        enlarged = label.join(full, "component", "left_semi").join(nodes, "node").select("component", "node", "vec", "copies")
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        rest = both.join(label.join(full, "component", "left_anti").select("node"), "node", "left_semi")
        counted = rest.join(nodes.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("linked"))
        linked = stored(_within(enlarged, dim, threshold, block).union(counted))
        recall = _audit(nodes, linked, seen, dim, threshold, queries)
        log.info("%d vectors of %d dimensions, attempt %d: recall %.4f", size, dim, attempt + 1, recall)
        if recall >= least_recall:
            return linked, label
    raise RuntimeError(f"{size} vectors of {dim} dimensions: recall {recall:.3f} after {attempts} attempts, {least_recall} needed")


def link(vectors: DataFrame, threshold: float = 0.9, k: int = 16, trees: int = 16, reach: int = 8, rounds: int = 4, block: int = 4096, least_recall: float = 0.97, queries: int = 512, attempts: int = 3) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("vec"))
    real = "vec is not null and size(vec) > 0 and not exists(vec, x -> x is null or isnan(x) or abs(x) = double('inf')) and exists(vec, x -> x <> 0)"
    rows = rows.withColumn("vec", F.when(F.expr(real), F.transform("vec", lambda x: x + F.lit(0.0))))
    classes = rows.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()))
    out = []
    for dim in [r[0] for r in classes.groupBy(F.size("vec").alias("d")).count().collect()]:
        nodes = classes.where(F.size("vec") == dim)
        linked, label = _search(nodes, dim, threshold, k, trees, reach, rounds, block, least_recall, queries, attempts)
        named = nodes.select("node", "rep").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
        lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
        out.append(named.join(lowest, "component").join(linked, "node", "left").select("node", "component_id", F.coalesce("linked", F.lit(0)).alias("linked")))
    if not out:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    by_class = found.join(classes.select("node", "copies", "vec"), "node").select("vec", (F.col("linked") + F.col("copies") - 1).alias("n_links"), "component_id")
    whole = rows.join(by_class, "vec", "left")
    own = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"), own.eqNullSafe(F.col("vec_id")).alias("kept"))


#: The same rows by comparing all pairs, for small tables (unique vec_ids).
SQL = """
    WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
    r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
    c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x), n AS (SELECT x AS vec_id, count(*) AS n_links FROM l GROUP BY x)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)"""
