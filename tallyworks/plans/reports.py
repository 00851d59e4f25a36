"""Reports for people: ordered results."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.aggregates import percentage
from tallyworks.operators import aggregates, filters, joins, sorting


def failed_users(
    fact: DataFrame,
    dim_users: DataFrame,
    as_of: date,
    lookback_days: int = 7,
    more_than: int = 3,
) -> DataFrame:
    """Current users with repeated recent failures, and those as a share of all they ever did.

    Both counts of a user come from one scan and one grouping. Rows are counted before the shuffle,
    so a user with a large share of them sends one row per task; the users join the reduced counts.
    """
    counts = (
        fact.groupBy("user_id")
        .agg(
            F.count_if(filters.is_recent_failure(as_of, lookback_days)).alias("failed_count"),
            F.count("*").alias("total_count"),
        )
        .where(F.col("failed_count") > more_than)
    )
    users = filters.current_rows(dim_users).select("user_id", "user_name", "user_category")
    report = joins.users_with_failures(users, counts).select(
        "user_id",
        "user_name",
        "user_category",
        "failed_count",
        percentage(F.col("failed_count"), F.col("total_count")).alias("failure_rate"),
    )
    return sorting.by_failures(report)


def daily_summary(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return sorting.by_day(aggregates.daily_summary(fact, dim_date))
