"""Error-log jobs."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import parsing
from tallyworks.functions.dates import hour_floor
from tallyworks.operators import aggregates, filters
from tallyworks.session import scratch, written
from tallyworks.sinks import files
from tallyworks.sources import logs_json

logger = logging.getLogger(__name__)


def clean_logs(df: DataFrame, strict: bool = True) -> DataFrame:
    """Parsed timestamp, endpoint path and shortened user agent."""
    return df.withColumns(
        {
            "timestamp": parsing.log_timestamp(F.col("timestamp"), strict),
            "endpoint_clean": parsing.endpoint_path(F.col("endpoint")),
            "user_agent_clean": parsing.short_user_agent(F.col("user_agent")),
        }
    )


def summarize_errors(logs: DataFrame, endpoint_col: str = "endpoint") -> DataFrame:
    """Hourly summary of server errors; the raw endpoint is the key unless the caller picks another."""
    errors = clean_logs(filters.server_errors(logs)).withColumn("hour", hour_floor(F.col("timestamp")))
    return aggregates.error_summary(errors, endpoint_col)


def error_rows(logs: DataFrame) -> DataFrame:
    """Server errors as rows, with parsed timestamp and its hour."""
    errors = filters.server_errors(logs).withColumn("timestamp", parsing.log_timestamp_infer(F.col("timestamp")))
    return errors.withColumn("hour", hour_floor(F.col("timestamp")))


def error_log_summary(spark: SparkSession, input_path: str, output_path: str, by_day: bool = False) -> DataFrame:
    """Strict scan to hourly summary to parquet; returns what was written."""
    summary = summarize_errors(logs_json.read_logs(spark, input_path))
    files.write_summary(summary, output_path, "hour" if by_day else None)
    return spark.read.parquet(output_path)


def error_log_rows(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    rows_per_file: int | None = None,
    bad_lines_path: str | None = None,
) -> DataFrame:
    """Tolerant scan to error rows to parquet; returns what was written.

    Lines that are no records are kept with their file under ``bad_lines_path``, by default ``output_path`` with
    ``-bad-lines``, and counted in a warning. The text is read and parsed once: error rows and bad lines are landed
    together in the shared folder and told apart there.
    """
    seen = Observation()
    lines = spark.read.text(input_path).select("value", F.col("_metadata.file_path").alias("file"))
    parsed = logs_json.parse_lines(logs_json.spread_hot_files(lines, input_path)).observe(seen, F.count("*").alias("lines"), F.count_if("is_bad").alias("bad"))
    status = F.col("record.status_code")
    wanted = parsed.where(F.col("is_bad") | (status >= filters.SERVER_ERROR))
    flat = wanted.select("is_bad", F.when(F.col("is_bad"), F.struct("file", "value")).alias("bad"), "record.*").drop(logs_json.CORRUPT)
    with scratch(spark, "log-rows") as folder:
        landed = written(flat, folder)
        rows = error_rows(landed.where(~F.col("is_bad")).drop("is_bad", "bad"))
        files.write_chunks(rows, output_path, rows_per_file=rows_per_file)
        landed.where("is_bad").select("bad.*").write.mode("overwrite").parquet(bad_lines_path or f"{output_path.rstrip('/')}-bad-lines")
    if seen.get["bad"]:
        logger.warning("%d of %d lines of %s are no records", seen.get["bad"], seen.get["lines"], input_path)
    return spark.read.schema(rows.schema).parquet(output_path)
