"""Hourly error summary that takes rows however late they come: each micro-batch is merged into the hours it touches.

Kept for an hour: partial sums per endpoint and user, and the summary made of them (``sinks/periods.py``). One record
points to the folders of all hours and says which micro-batch was merged last. So a micro-batch counts once, also if it
is repeated after a loss, other hours are not touched, and readers see all of a micro-batch or nothing. What a record no
longer points to is deleted two micro-batches later.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.functions import parsing
from tallyworks.functions.dates import hour_floor
from tallyworks.operators.filters import SERVER_ERROR
from tallyworks.session import remove, scratch, written
from tallyworks.sinks import claims
from tallyworks.sinks.periods import Periods
from tallyworks.sources.logs_json import parse_lines

STATE = "endpoint string, user_id bigint, n bigint, n_timed bigint, total double, longest double, shortest double"
SUMMARY = (
    "endpoint string, error_count bigint, avg_response_time double, max_response_time double, min_response_time double,"
    " unique_users bigint"
)
_HOUR = "yyyy-MM-dd-HH"  # as folder names have it


def _merged(states: DataFrame) -> DataFrame:
    """One row per hour, endpoint and user; combined before the shuffle, which a hot hour or endpoint enters by users."""
    return states.groupBy("hour", "endpoint", "user_id").agg(
        F.sum("n").alias("n"), F.sum("n_timed").alias("n_timed"), F.sum("total").alias("total"),
        F.max("longest").alias("longest"), F.min("shortest").alias("shortest"),
    )


def _summaries(merged: DataFrame) -> DataFrame:
    return merged.groupBy("hour", "endpoint").agg(
        F.sum("n").alias("error_count"), F.try_divide(F.sum("total"), F.sum("n_timed")).alias("avg_response_time"),
        F.max("longest").alias("max_response_time"), F.min("shortest").alias("min_response_time"), F.count("*").alias("unique_users"),
    )


class HourlyErrors:
    """The kept state and summaries below one folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.records = claims.Folder(spark, f"{self.path}/records")
        self.periods = Periods(spark, self.path, "hour", STATE, SUMMARY, _merged, _summaries)

    def record(self) -> dict[str, Any]:
        """``hours`` (its folders of partial sums, and of its summary), the last ``batch``, and what was counted."""
        empty = {"hours": {}, "batch": -1, "lines": 0, "errors": 0, "aside": 0, "replaced": [], "old": []}
        return self.records.read("now") or empty

    def summary(self) -> DataFrame:
        """The summary of all hours as of the last micro-batch."""
        rows = self.periods.results(self.record()["hours"])
        return rows.withColumn("hour", F.to_timestamp_ntz("hour", F.lit(_HOUR)))

    def aside(self) -> DataFrame:
        """Lines that fit no hour, with the reason."""
        paths = [f"{self.path}/aside/{n}" for n in range(self.record()["batch"] + 1)]
        system = self.records.system
        have = [p for p in paths if system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p))]
        return self.spark.read.schema("value string, reason string").parquet(*have) if have else self.spark.createDataFrame([], "value string, reason string")

    def merge(self, lines: DataFrame, number: int) -> None:
        """Merge one micro-batch of text lines; one that was merged before changes nothing."""
        now = self.record()
        if number <= now["batch"]:
            return
        for gone in now["old"]:
            remove(self.spark, f"{self.path}/{gone}")
        seen = Observation()
        parsed = parse_lines(lines)
        time = parsing.log_timestamp(F.col("record.timestamp"), strict=False)
        reason = F.when(F.col("is_bad"), F.lit("not a record")).when(time.isNull(), F.lit("time does not parse"))
        rows = parsed.select(
            F.date_format(hour_floor(time), _HOUR).alias("hour"), F.col("record.endpoint").alias("endpoint"), F.col("record.user_id").alias("user_id"),
            F.col("record.response_time").alias("response_time"), F.col("record.status_code").alias("status_code"), reason.alias("reason"),
            F.when(reason.isNotNull(), F.col("value")).alias("value"),
        ).observe(seen, F.count("*").alias("lines"), F.count("reason").alias("aside"))
        with scratch(self.spark, "hours") as folder:
            wanted = F.col("reason").isNotNull() | (F.col("status_code") >= SERVER_ERROR)
            kept = written(rows.where(wanted), folder)
            counted = seen.get
            if counted["aside"]:
                kept.where("reason is not null").select("value", "reason").write.mode("overwrite").parquet(f"{self.path}/aside/{number}")
            took = F.col("response_time")
            partial = kept.where("reason is null").groupBy("hour", "endpoint", "user_id").agg(
                F.count("*").alias("n"), F.count(took).alias("n_timed"), F.sum(took).alias("total"), F.max(took).alias("longest"), F.min(took).alias("shortest")
            )
            now["hours"], replaced, per_hour = self.periods.fold(now["hours"], partial)
        counts = {"lines": counted["lines"], "aside": counted["aside"], "errors": sum(per_hour.values())}
        self.records.write("now", now | {k: now[k] + v for k, v in counts.items()} | {"batch": number, "old": now["replaced"], "replaced": replaced})


def merge_new_files(spark: SparkSession, input_path: str, output_path: str, checkpoint: str, max_files: int | None = None) -> StreamingQuery:
    """Merge the log files that arrived into ``output_path``; ``HourlyErrors(spark, output_path).summary()`` reads it.

    Every line is counted, in its hour or aside. One query at a time may write to an output, as to any checkpoint.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    kept = HourlyErrors(spark, output_path)
    writer = reader.load(input_path).writeStream.foreachBatch(kept.merge).option("checkpointLocation", checkpoint)
    return writer.outputMode("update").trigger(availableNow=True).start()
