"""Star schema: tables, date dimension, views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.dates import date_parts
from tallyworks.operators import aggregates, joins
from tallyworks.schemas import STAR_SCHEMA
from tallyworks.sinks import tables

# Span of the date dimension.
DIM_DATE_START = date(2023, 1, 1)
DIM_DATE_DAYS = 365 * 5 + 1


def create_star_schema(spark: SparkSession, database: str | None = None) -> None:
    """Create the four tables where they are missing."""
    tables.create_tables(spark, STAR_SCHEMA, database)


def date_series(spark: SparkSession, start: date = DIM_DATE_START, days: int = DIM_DATE_DAYS) -> DataFrame:
    """All days from ``start`` on; a range, so the planner knows the exact number of rows."""
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))


def dates_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """All days from one column to another of a one-row frame, both included."""
    return bounds.select(F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))).alias("full_date"))


def dates_spanning(df: DataFrame, column: str) -> DataFrame:
    """All days between the first and the last value of a column."""
    return dates_between(df.agg(F.min(column).alias("first"), F.max(column).alias("last")), "first", "last")


def date_dimension(days: DataFrame, trim_names: bool = False) -> DataFrame:
    """Rows of the date dimension for the days in ``full_date``."""
    return days.select(*date_parts(F.col("full_date"), trim_names))


def default_date_dimension(spark: SparkSession) -> DataFrame:
    return date_dimension(date_series(spark))


def load_dim_date(spark: SparkSession, table: str, days: DataFrame | None = None) -> None:
    """Insert the days the table does not have yet."""
    days = date_series(spark) if days is None else days
    tables.append(date_dimension(joins.missing_keys(days, spark.table(table), "full_date")), table, checked=True)


def create_daily_view(
    spark: SparkSession, fact: DataFrame, dim_date: DataFrame, name: str = "daily_transaction_summary"
) -> DataFrame:
    """Register the daily summary as a view; its readers choose the order."""
    aggregates.daily_summary(fact, dim_date).createOrReplaceTempView(name)
    return spark.table(name)
