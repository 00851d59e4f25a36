"""Row filters. All are plain predicates, so they reach a parquet scan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.aggregates import watermark
from tallyworks.schemas import VALID_STATUSES

SERVER_ERROR = 500  # fixed value: lowest status code that counts as a server error


def is_positive(amount: Column) -> Column:
    return amount > 0


def is_valid(status: Column) -> Column:
    return status.isin(*VALID_STATUSES)


def positive_amount(df: DataFrame) -> DataFrame:
    """Cleaning rule: zero, negative and unparsed amounts go."""
    return df.where(is_positive(F.col("amount")))


def valid_status(df: DataFrame) -> DataFrame:
    """Cleaning rule: only the accepted statuses stay; NULL goes."""
    return df.where(is_valid(F.col("status")))


def server_errors(df: DataFrame) -> DataFrame:
    return df.where(F.col("status_code") >= SERVER_ERROR)


def negative_amount(df: DataFrame) -> DataFrame:
    """Quality rule: zero is tolerated here."""
    return df.where(F.col("amount") < 0)


def invalid_status(df: DataFrame) -> DataFrame:
    """Quality rule: NULL status is not reported."""
    return df.where(~F.col("status").isin(*VALID_STATUSES))


def is_recent_failure(as_of: date, lookback_days: int = 7) -> Column:
    start = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(lookback_days))
    return (F.col("status") == "failed") & (F.col("created_at") >= start)


def recent_failures(df: DataFrame, as_of: date, lookback_days: int = 7) -> DataFrame:
    """Failed transactions since ``lookback_days`` before the given day."""
    return df.where(is_recent_failure(as_of, lookback_days))


def having_more_than(df: DataFrame, keys: list[str], threshold: int, count_name: str = "n") -> DataFrame:
    """Groups with more than ``threshold`` rows, with their size."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name)).where(F.col(count_name) > threshold)


def current_rows(dim: DataFrame) -> DataFrame:
    """Current versions of a slowly changing dimension."""
    return dim.where(F.col("is_current"))


def since_watermark(df: DataFrame, target: DataFrame, column: str = "processed_at") -> DataFrame:
    """Rows at or after the target's latest ``column``, through a scalar subquery."""
    latest = target.agg(watermark(F.col(column)).alias("latest"))
    return df.where(F.col(column) >= latest.scalar())
