"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A table of more rows than this is never broadcast for the size of its files, which may be a hundredth of what the rows take in memory.
MOST_BROADCAST_ROWS = 200_000

#: Rows that a task sorts or groups, where it is known how many there are.
TASK_ROWS = 250_000


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path under spark.checkpoint.dir; on a local master without one, in a folder set for the session."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Written and read again: cuts the lineage and survives lost executors. Large tables are joined by sorting (see MOST_BROADCAST_ROWS)."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    # counted from the files' footers
    return out.hint("merge") if out.count() > MOST_BROADCAST_ROWS else out


def dealt(df: DataFrame, keys: list[str], rows: int | None) -> DataFrame:
    """Dealt out by keys to tasks of about TASK_ROWS of `rows` rows, so that a task's memory doesn't grow with the table; of few or an unknown
    number of rows Spark decides."""
    tasks = -(-(rows or 0) // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df
