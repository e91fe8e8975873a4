"""Event-time windows over the events table. The reference has no stream; these are ours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hourly_batch(events: DataFrame) -> DataFrame:
    """hour, event_type, n and total of a whole table."""
    return events.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def hourly_stream(spark: SparkSession, folder: str, schema, late: str = "2 hours") -> DataFrame:
    """The same from a folder of Parquet files as they come; rows later than `late` are dropped."""
    rows = spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))
    windows = rows.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "event_type")
    return windows.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("hour"), "event_type", "n", "total")


def sessions_stream(spark: SparkSession, folder: str, schema, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each user: events closer than `gap` are one."""
    rows = spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))
    grouped = rows.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id")
    return grouped.agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("begins"), F.col("session_window.end").alias("ends"), "n")
