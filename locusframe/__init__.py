"""locusframe: interval, evidence and sequence analytics as Spark DataFrame plans."""
