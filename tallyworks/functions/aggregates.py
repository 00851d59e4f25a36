"""Aggregate and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.schemas import EPOCH_WATERMARK


def nunique_with_null(c: Column) -> Column:
    """Distinct values of a group, NULL counting as one value of its own."""
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("bigint")), F.lit(0).cast("bigint"))


def exact_total(c: Column) -> Column:
    """Sum of a decimal column, added exactly and turned into a double at the end."""
    return F.sum(c).cast("double")


def exact_mean(c: Column) -> Column:
    """Mean of a decimal column from its exact sum: avg(decimal) would cut digits."""
    return F.sum(c).cast("double") / F.count(c)


def percentage(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, in double arithmetic."""
    return part.cast("double") * F.lit(100.0) / whole


def watermark(c: Column) -> Column:
    """Latest value of a timestamp column, or a time before all data if there is none."""
    return F.coalesce(F.max(c), F.lit(EPOCH_WATERMARK).cast("timestamp_ntz"))
