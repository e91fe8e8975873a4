"""Small helpers that several operators use: shared folders, written tables, ordering, columns."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path under the cluster's shared folder (spark.checkpoint.dir).

    Only where the setting is absent and the master is local (tests) a local folder is set for the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def bounded_batches(df: DataFrame, most_bytes: int = 16 << 20) -> DataFrame:
    """Limits what one Arrow batch holds, for texts of any length (Spark's own limit counts rows)."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))
    return df


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_points(df: DataFrame, col: str, n: int) -> list:
    """At most n ascending values of `col` that occur in it and split it about evenly."""
    if n < 1:
        return []
    at = [(i + 1) / (n + 1) for i in range(n)]
    got = df.agg(F.percentile_approx(col, at, 10 * (n + 1)).alias("q")).head()[0]
    return sorted({x for x in got or [] if x is not None})


def range_of(col: str, cuts: list[int]):
    """How many of the ascending `cuts` are <= the value; null counts as the smallest value.

    Cuts stand in groups, of which one is looked through, so a row takes about 2 * sqrt(len(cuts)) steps."""
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    heads, rest = F.from_json(F.lit(str([g[0] for g in groups])), "array<bigint>"), F.from_json(F.lit(str(groups)), "array<array<bigint>>")
    below = F.size(F.filter(heads, lambda c: c <= F.col(col)))
    inside = F.size(F.filter(F.element_at(rest, F.greatest(below, F.lit(1))), lambda c: c <= F.col(col)))
    return F.when(F.col(col).isNull(), 0).otherwise((F.greatest(below, F.lit(1)) - 1) * step + inside)


def is_cut(col: str, cuts: list[int]):
    """Whether the value is one of the ascending `cuts`."""
    if not cuts:
        return F.lit(False)
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    heads, rest = F.from_json(F.lit(str([g[0] for g in groups])), "array<bigint>"), F.from_json(F.lit(str(groups)), "array<array<bigint>>")
    below = F.size(F.filter(heads, lambda c: c <= F.col(col)))
    return (below > 0) & F.array_contains(F.element_at(rest, F.greatest(below, F.lit(1))), F.col(col))


def ranges_for(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def prefix_sum(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of `value` over all rows before, by `order` (unique, its first column a number).

    Rows go to value ranges of the first column; windows run inside a range, and one row
    per range carries the sums on, so no task holds more than a range.
    """
    cuts = cut_points(df, order[0], ranges_for(df.sparkSession) - 1)
    ranged = df.withColumn("_range", range_of(order[0], cuts))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .select("_range", "_base")
    )
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn(out, F.coalesce(F.sum(value).over(own), F.lit(0)))
    return inside.join(F.broadcast(base), "_range").withColumn(out, F.col(out) + F.col("_base")).drop("_range", "_base")
