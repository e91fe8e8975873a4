"""Tables of the shared folder."""

from pyspark.sql import functions as F

from locusframe import shared


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_long_tables_that_compress_well_are_not_broadcast(spark):
    n = shared.MOST_BROADCAST_ROWS + 1
    many = shared.stored(spark.range(n).select((F.col("id") / 1000).cast("long").alias("k"), F.lit(1).alias("v")))
    other = spark.range(1 << 40).withColumnRenamed("id", "k")
    assert "BroadcastExchange" not in _plan(other.join(many.select("k"), "k"))
    assert many.count() == n
    few = shared.stored(spark.range(10).withColumnRenamed("id", "k"))
    assert "BroadcastExchange" in _plan(other.join(few, "k"))
