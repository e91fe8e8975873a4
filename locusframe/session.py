"""Session helpers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's source to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = Path(__file__).resolve().parent
        to = Path(tempfile.mkdtemp(prefix="spark-ship-")) / "locusframe.zip"
        with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(to))
    return spark
