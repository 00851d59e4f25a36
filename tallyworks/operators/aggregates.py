"""Grouped and global aggregates. All combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.aggregates import exact_mean, exact_total, nunique_with_null, watermark
from tallyworks.operators import filters


def daily_summary(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per day and status: rows, amounts and distinct users.

    The distinct count makes Spark group by (day, status, user) first, so a hot day or status is
    spread over its users before anything is gathered per group.
    """
    return (
        fact.join(dim_date.select("date_id", "full_date"), "date_id")
        .groupBy(F.col("full_date").alias("transaction_date"), "status")
        .agg(
            F.count("*").alias("transaction_count"),
            exact_total(F.col("amount")).alias("total_amount"),
            exact_mean(F.col("amount")).alias("average_amount"),
            F.count_distinct("user_id").alias("unique_users"),
        )
    )


def error_summary(errors: DataFrame, endpoint_col: str = "endpoint", hour_col: str = "hour") -> DataFrame:
    """Per hour and endpoint: error rows, response times, distinct users with NULL as one user."""
    time = F.col("response_time")
    return errors.groupBy(hour_col, F.col(endpoint_col).alias("endpoint")).agg(
        F.count("*").alias("error_count"),
        F.avg(time).alias("avg_response_time"),
        F.max(time).alias("max_response_time"),
        F.min(time).alias("min_response_time"),
        nunique_with_null(F.col("user_id")).alias("unique_users"),
    )


def distinct_with_null(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(nunique_with_null(F.col(column)).alias("n_unique"))


def failures_per_user(fact: DataFrame, as_of: date, lookback_days: int = 7, more_than: int = 3) -> DataFrame:
    recent = filters.recent_failures(fact, as_of, lookback_days)
    return filters.having_more_than(recent, ["user_id"], more_than, "failed_count")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def negative_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("amount") < 0).alias("negative_count"))


def invalid_status_counts(df: DataFrame) -> DataFrame:
    """Every status outside the accepted ones with its number of rows."""
    return filters.invalid_status(df).groupBy("status").agg(F.count("*").alias("count"))


def duplicate_keys(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keys that occur more than once; NULL keys form one group."""
    return filters.having_more_than(df, [key], 1, "count")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def max_watermark(df: DataFrame, column: str = "processed_at") -> DataFrame:
    return df.agg(F.max(column).alias("max_processed_at"))


def coalesced_watermark(df: DataFrame, column: str = "processed_at") -> DataFrame:
    return df.agg(watermark(F.col(column)).alias("watermark"))
