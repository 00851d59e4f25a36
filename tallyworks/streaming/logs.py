"""Hourly error summary over logs as they arrive: an hour is emitted once, when it is complete. ``hours`` takes late rows, too."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.functions import parsing
from tallyworks.operators.filters import SERVER_ERROR
from tallyworks.schemas import LOG_RECORD
from tallyworks.session import setting
from tallyworks.sources.logs_json import parse_lines


logger = logging.getLogger(__name__)

#: Micro-batches of one run whose reports are kept; a few KB each.
REPORTS = 100_000


class LateRowsError(ValueError):
    """Raised where rows that came too late for their hour must not be left out."""


def _lines(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_lines(reader.load(path))


def read_log_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Records of the good lines of new files."""
    parsed = _lines(spark, path, max_files)
    return parsed.where(~F.col("is_bad")).select(*[F.col(f"record.{n}").alias(n) for n in LOG_RECORD.names])


def hourly_errors(logs: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Error summary per hour and endpoint, an hour being emitted once no more rows can join it.

    Two chained aggregations: first per hour, endpoint and user, which spreads a hot endpoint over
    its users and keeps one small state row per user; then per hour and endpoint, where the rows of
    the first step are the distinct users, NULL included. No set of users is ever held.

    The watermark follows all traffic, not only the errors, so quiet endpoints do not keep hours
    open. For that the error filter must stay above the watermark, hence its reference to the event
    time; a plain filter would be pushed below.
    """
    timed = logs.withColumn(
        "event_time", parsing.log_timestamp(F.col("timestamp"), strict=False).cast("timestamp")
    ).withWatermark("event_time", delay)
    errors = timed.where(F.when(F.col("event_time").isNotNull(), F.col("status_code")) >= SERVER_ERROR)
    time = F.col("response_time")
    per_user = errors.groupBy(F.window("event_time", "1 hour").alias("w"), "endpoint", "user_id").agg(
        F.count("*").alias("n"),
        F.count(time).alias("n_timed"),
        F.sum(time).alias("total"),
        F.max(time).alias("longest"),
        F.min(time).alias("shortest"),
    )
    per_endpoint = per_user.groupBy(F.window("w", "1 hour").alias("hours"), "endpoint").agg(
        F.sum("n").alias("error_count"),
        F.try_divide(F.sum("total"), F.sum("n_timed")).alias("avg_response_time"),
        F.max("longest").alias("max_response_time"),
        F.min("shortest").alias("min_response_time"),
        F.count("*").alias("unique_users"),
    )
    return per_endpoint.withColumn("hour", F.col("hours.start").cast("timestamp_ntz")).drop("hours")


def summarize_new_files(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint: str,
    delay: str = "1 hour",
    max_files: int | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Process the files that arrived and append the hours that are complete.

    ``state_partitions`` is fixed by the first run on a checkpoint; choose it for the volume to come.
    The session's number of shuffle partitions applies otherwise.
    """
    summary = hourly_errors(read_log_stream(spark, input_path, max_files), delay)
    writer = summary.writeStream.format("parquet").option("path", output_path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    # ``finish`` adds the reports of all micro-batches up; by default a query forgets all but the last hundred
    with setting(spark, "spark.sql.shuffle.partitions", state_partitions), setting(spark, "spark.sql.streaming.numRecentProgressUpdates", REPORTS):
        return writer.start()


def keep_unplaced_lines(
    spark: SparkSession, input_path: str, output_path: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Lines of new files that fit no hour: bad ones, and records whose time does not parse, with the reason.

    A query of its own beside the summary, for a stream has one sink.
    """
    parsed = _lines(spark, input_path, max_files)
    reason = F.when(F.col("is_bad"), F.lit("not a record")).when(
        parsing.log_timestamp(F.col("record.timestamp"), strict=False).isNull(), F.lit("time does not parse")
    )
    rows = parsed.select("value", reason.alias("reason")).where(F.col("reason").isNotNull())
    writer = rows.writeStream.format("parquet").option("path", output_path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def finish(query: StreamingQuery, fail_on_late: bool = False) -> int:
    """Wait for a summary and return how many of its rows came after their hour was closed; they are logged, or raised.

    Rows of the first aggregation's state are counted, as the query reports them.
    """
    query.awaitTermination()
    late = sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
    if late:
        message = f"{late} rows came too late for their hour"
        if fail_on_late:
            raise LateRowsError(message)
        logger.warning(message)
    return late


def heartbeat(spark: SparkSession, input_path: str, at: datetime) -> None:
    """Add a log line that is no error and only tells the stream that time has reached ``at``.

    It lets the last hours of an input that has ended be emitted.
    """
    line = spark.range(1).select(
        F.lit(at.strftime("%Y-%m-%d %H:%M:%S")).alias("timestamp"), F.lit(200).alias("status_code")
    )
    line.write.mode("append").json(input_path)
