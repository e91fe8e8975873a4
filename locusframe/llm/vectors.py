"""Vectors as whole numbers, dealt into blocks that a stated query set meets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.llm.shared import ranges_for, stored

#: Squared lengths stay below this, so that every inner product, and every part of its sum, is exact in double precision.
MOST_SQUARED = 2.0**52


def whole_numbers(df: DataFrame, vector: str, scale: int, **others: Column) -> DataFrame:
    """Rows that take part, written once: row (unique), dim, vec (floor(scale * x) of each component) and the named columns.

    A vector that is null, or holds a null or non-finite component, takes no part. One whose squared length
    reaches 2^52 after scaling is an error, as its products would not be exact."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    rows = df.where(usable).select(F.monotonically_increasing_id().alias("row"), scaled.alias("vec"), *[c.alias(n) for n, c in others.items()])
    squared = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)
    exact = F.when(squared < MOST_SQUARED, F.col("vec")).otherwise(F.raise_error(F.lit("a vector is too long for exact products")).cast("array<double>"))
    return stored(rows.withColumn("vec", exact).withColumn("dim", F.size("vec")))


def dealt(rows: DataFrame, most_bytes: int, least_rows: int) -> tuple[DataFrame, int]:
    """Rows with `block`, and the number of blocks: as many as tasks, but of at least `least_rows` rows and at most `most_bytes` of vectors."""
    n, size = rows.agg(F.count("*"), F.sum(F.col("dim") + 1)).head()
    blocks = max(1, min(ranges_for(rows.sparkSession), math.ceil(n / least_rows)), math.ceil(8 * (size or 0) / most_bytes))
    return rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), blocks


def spread(rows: DataFrame, name: str, n: int) -> DataFrame:
    """Every row once for each of the numbers below n."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def matrix(table: pa.Table, dim: int) -> np.ndarray:
    flat = table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat).reshape(table.num_rows, dim)


def by_id(table: pa.Table, *first: str) -> pa.Table:
    """In order of the given columns, then vec_id (null last) and row, so that of equal scores the earlier row comes first."""
    return table.sort_by([(c, "ascending") for c in (*first, "vec_id", "row")])
