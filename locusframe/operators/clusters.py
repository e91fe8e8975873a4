"""Clusters of intervals: by shadow, by overlap graph, by shared neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.operators.intervals import islands, overlap_join


def shadow_clusters(hits: DataFrame, keys: list[str], order: list[Column], depth: int, flank: int = 0, per: list[str] | None = None) -> DataFrame:
    """The piece that each hit falls into, and the first `depth` of each piece (and of each `per`) by `order`."""
    labelled = islands(hits, keys, flank, "cluster")
    if depth <= 0:
        return labelled.withColumn("rank", F.lit(None).cast("int"))
    w = Window.partitionBy(*keys, "cluster", *(per or [])).orderBy(*order)
    return labelled.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= depth)


#: Patterns of algorithm names (lower case) and how far each is trusted; the first that matches counts.
TRUST = [
    (r"^repeat", 0), (r"^blastx:repeatmask$", 0), (r"^snap$", 1), (r"^augustus$", 1), (r"^fgenesh$", 1), (r"^twinscan$", 1), (r"^jigsaw$", 1), (r"^pred_gff:", 1),
    (r"^blastn$", 2), (r"^tblastx$", 2), (r"^altest_gff:", 2), (r"^blastx$", 3), (r"^protein_gff:", 3), (r"2genome$", 4), (r"^est_gff:", 4), (r"^model_gff:", 5),
]


def evidence_class(algorithm: Column, own: str) -> Column:
    """How far an algorithm is trusted, 0 to 5; null for unknown names. own: the source name of finished models, which rank highest."""
    name = F.lower(algorithm)
    return F.coalesce(*[F.when(name.rlike(pattern), level) for pattern, level in TRUST], F.when(name == own.lower(), max(v for _, v in TRUST)))


def best_score(score: Column, bits: Column, significance: Column) -> Column:
    """Score, else bits, else 10000 - 10000 * significance (at least 0), else 0; only finite numbers count."""

    def number(c: Column) -> Column:
        x = c.cast("string").try_cast("double")
        return F.when(F.abs(x) < float("inf"), x)

    return F.coalesce(number(score), number(bits), F.greatest(10000 - 10000 * number(significance), F.lit(0.0)), F.lit(0.0))


def components_in_groups(rows: DataFrame, keys: list[str], node: str) -> DataFrame:
    """C3, C4, C7 inside groups that no overlap crosses: nodes whose intervals overlap, transitively.

    A node may have several intervals. Groups should be overlap components of the whole spans, so
    that each fits in memory and results are exact. Adds `component`, the smallest node reachable."""
    schema = rows.select(*keys, node).schema.add("component", rows.schema[node].dataType)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, parent, end, open_node = None, {}, None, None

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def flush(out: list) -> None:
            out += [(*group, x, root(x)) for x in parent] if group is not None else []

        for pdf in batches:
            out: list[tuple] = []
            for *key, x, s, e in zip(*(pdf[c].tolist() for c in (*keys, node, "s", "e")), strict=True):
                if key != group:
                    flush(out)
                    group, parent, end = key, {}, None
                # what is open at s holds s, so it is one component already: the farthest end speaks for all
                if end is not None and s <= end:
                    a, b = root(x), root(open_node)
                    parent[max(a, b)] = min(a, b)
                root(x)
                if end is None or e > end or s > end:
                    end, open_node = e, x
            yield pd.DataFrame(out, columns=[*keys, node, "component"])
        last: list[tuple] = []
        flush(last)
        yield pd.DataFrame(last, columns=[*keys, node, "component"])

    ordered = rows.select(*keys, node, "s", "e").repartition(*keys).sortWithinPartitions(*keys, "s", "e")
    return ordered.mapInPandas(solve, schema)


def overlap_edges(a: DataFrame, keys: list[str], node: str) -> DataFrame:
    """Pairs x < y of nodes whose spans overlap."""
    left = a.select(*keys, F.col(node).alias("x"), "s", "e")
    right = a.select(*keys, F.col(node).alias("y"), "s", "e")
    return overlap_join(left, right, keys, bin_sizes=(64, 1024, 1 << 14)).where("x < y").select(*keys, "x", "y").distinct()


def jaccard_edges(edges: DataFrame, keys: list[str], least: float) -> DataFrame:
    """The edges whose ends share enough neighbours: (common + 1) / (degrees - common - 1) >= least; at 1 degrees must agree too.

    At most the smaller degree can be common, so edges between unlike degrees go first; lists of neighbours meet only for the rest."""
    both = edges.select(*keys, "x", "y").union(edges.select(*keys, "y", "x"))
    around = both.groupBy(*keys, "x").agg(F.collect_list("y").alias("near"))
    degree = around.select(*keys, "x", F.size("near").alias("d"))
    sized = edges.join(degree.withColumnRenamed("d", "dx"), [*keys, "x"]).join(degree.select(*keys, F.col("x").alias("y"), F.col("d").alias("dy")), [*keys, "y"])
    sized = sized.where(F.least("dx", "dy") >= F.greatest("dx", "dy") * least)
    near = sized.join(around.withColumnRenamed("near", "nx"), [*keys, "x"]).join(around.select(*keys, F.col("x").alias("y"), F.col("near").alias("ny")), [*keys, "y"])
    n = F.size(F.array_intersect("nx", "ny")) + 1
    scored = near.withColumn("jaccard", n / (F.col("dx") + F.col("dy") - n))
    keep = F.col("jaccard") >= least
    if least == 1:
        keep &= F.col("dx") == F.col("dy")
    return scored.where(keep).select(*keys, "x", "y", "jaccard")
