"""Numbers over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusframe.shared import stored


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds each row's place (from 1) in a total order.

    Rows are dealt by ranges of the whole order, so that equal first columns are dealt to many tasks; each range is numbered by itself,
    and what stands before it, a row per range, is added."""
    ranged = stored(rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_base")
    return ranged.join(base, "_range").withColumn(name, place).drop("_range", "_base")
