"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_WIDTH = 9  # fixed value: day and month names are blank-padded to the longest one
WEEKEND = (6, 7)  # fixed value: ISO days of the week


def hour_floor(ts: Column) -> Column:
    """Start of the hour, staying in timestamp_ntz (date_trunc would go through the session zone)."""
    return ts - F.make_dt_interval(mins=F.minute(ts), secs=F.extract(F.lit("SECOND"), ts))


def date_key(d: Column) -> Column:
    """Date or timestamp to the integer YYYYMMDD, by arithmetic rather than by formatting text."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(d) + 1


def is_weekend(d: Column) -> Column:
    return iso_day_of_week(d).isin(*WEEKEND)


def _name(d: Column, pattern: str, trim: bool) -> Column:
    name = F.date_format(d, pattern)
    return name if trim else F.rpad(name, NAME_WIDTH, " ")


def date_parts(d: Column, trim_names: bool = False) -> list[Column]:
    """All columns of the date dimension for a date, in table order."""
    return [
        date_key(d).alias("date_id"),
        d.cast("date").alias("full_date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        iso_day_of_week(d).alias("day_of_week"),
        _name(d, "EEEE", trim_names).alias("day_name"),
        _name(d, "MMMM", trim_names).alias("month_name"),
        is_weekend(d).alias("is_weekend"),
    ]
