"""Joins. Broadcasting is left to the planner, which compares real sizes with its threshold and
falls back to a shuffle join, split by AQE where a key is hot; no side is forced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return fact.join(dim_date, "date_id")


def users_with_failures(dim_users: DataFrame, failures: DataFrame) -> DataFrame:
    """Attach the users to per-user counts; both sides hold a user once."""
    return dim_users.join(failures, "user_id")


def missing_keys(new: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``new`` the target does not have: a hash aggregate over the key alone, then an anti join."""
    return new.select(key).distinct().join(target.select(key), key, "left_anti")


def insert_missing(new: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """New rows, one per key, whose key the target does not have yet."""
    return new.dropDuplicates([key]).join(target.select(key), key, "left_anti")


def missing_parents(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys of ``child`` that ``parent`` lacks.

    Keys are reduced before the join, so a key that holds a large share of the rows costs one row.
    """
    return child.select(key).where(F.col(key).isNotNull()).distinct().join(parent.select(key), key, "left_anti")


def existing_keys(new: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys of ``new`` the target holds already.

    The target is the probe side: with a new batch under the broadcast threshold it is scanned once
    and not shuffled, which an anti join against it could not avoid. Only keys within the range of
    the new ones can match, so with growing ids most of an old table is skipped by its statistics.
    """
    keys = new.select(key).distinct()
    within = target.select(key).where(
        (F.col(key) >= new.agg(F.min(key).alias("low")).scalar())
        & (F.col(key) <= new.agg(F.max(key).alias("high")).scalar())
    )
    return within.join(keys, key, "left_semi").distinct()


def fk_orphans(fact: DataFrame, dim_users: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows without a parent user or a parent date, with a flag for each."""
    users = missing_parents(fact, dim_users, "user_id").withColumn("orphan_user", F.lit(True))
    dates = missing_parents(fact, dim_date, "date_id").withColumn("orphan_date", F.lit(True))
    flagged = fact.join(users, "user_id", "left").join(dates, "date_id", "left")
    return flagged.withColumns(
        {c: F.coalesce(F.col(c), F.lit(False)) for c in ("orphan_user", "orphan_date")}
    ).where(F.col("orphan_user") | F.col("orphan_date"))


def all_time_count_sql(fact_view: str, users_view: str) -> str:
    """Per current user the number of all its transactions, as a correlated subquery."""
    return (
        f"SELECT u.user_id, (SELECT count(*) FROM {fact_view} f WHERE f.user_id = u.user_id) AS total_count "
        f"FROM {users_view} u WHERE u.is_current"
    )
