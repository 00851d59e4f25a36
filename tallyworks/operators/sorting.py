"""Report orders. NULLs sort as the largest value, so they come first when descending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_day(summary: DataFrame) -> DataFrame:
    """Latest day first, then status."""
    return summary.orderBy(F.desc_nulls_first("transaction_date"), F.asc_nulls_last("status"))


def by_failures(report: DataFrame) -> DataFrame:
    """Most failures first; the user breaks ties, so the order is always the same."""
    return report.orderBy(F.desc_nulls_first("failed_count"), F.asc_nulls_last("user_id"))
