"""Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_FILE = 50_000  # fixed value: rows per chunk file


def write_summary(df: DataFrame, path: str, partition_by_day_of: str | None = None) -> None:
    """Snappy parquet that replaces what an earlier run wrote.

    ``partition_by_day_of`` names a timestamp column; its date becomes the partition column ``day``.
    """
    if partition_by_day_of is None:
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return
    daily = df.withColumn("day", F.col(partition_by_day_of).cast("date")).hint("rebalance", F.col("day"))
    daily.write.mode("overwrite").option("compression", "snappy").partitionBy("day").parquet(path)


def write_chunks(df: DataFrame, path: str, chunk: str | None = None, rows_per_file: int | None = None) -> None:
    """Snappy parquet in pieces; a piece without rows is not written.

    ``chunk`` stays a column: rows are gathered by it, neighbouring chunks share files, and the file size decides where
    files end, so there is no folder or file per chunk. ``rows_per_file`` cuts files by rows as well, for readers that
    need it (``ROWS_PER_FILE``).
    """
    if chunk:
        df = df.hint("rebalance", F.col(chunk)).sortWithinPartitions(chunk)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)
