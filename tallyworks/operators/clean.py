"""Cleaning of transaction rows. Each rule applies only if its column is there."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions import parsing
from tallyworks.operators import filters
from tallyworks.schemas import DATE_COLUMNS, ID_COLUMNS, TableSpec


def timestamp_literal(value: datetime):
    """A literal without a zone; F.lit of a datetime would carry the session's. An aware datetime is taken in UTC."""
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def map_missing_values(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """NULL for the missing-value spellings in every text column not in ``skip``."""
    return df.select(
        *[
            parsing.na_to_null(F.col(c)).alias(c) if _is_text(df, c) and c not in skip else F.col(c)
            for c in df.columns
        ]
    )


def parse_dates(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    present = [c for c in DATE_COLUMNS if c in df.columns]
    return df.withColumns(
        {
            c: parsing.parse_timestamp(F.col(c), formats) if _is_text(df, c) else F.col(c).cast("timestamp_ntz")
            for c in present
        }
    )


def parse_amount(df: DataFrame) -> DataFrame:
    if "amount" not in df.columns:
        return df
    c = F.col("amount")
    return df.withColumn("amount", parsing.parse_number(c) if _is_text(df, "amount") else parsing.finite(c.cast("double")))


def parse_ids(df: DataFrame) -> DataFrame:
    """Text keys to bigint."""
    keys = [c for c in ID_COLUMNS if c in df.columns and _is_text(df, c)]
    return df.withColumns({c: parsing.parse_id(F.col(c)) for c in keys})


def normalize_status(df: DataFrame) -> DataFrame:
    if "status" not in df.columns:
        return df
    return df.withColumn("status", parsing.normalize_status(F.col("status")))


def batch_name(run_ts: datetime) -> str:
    return f"batch_{run_ts:%Y%m%d_%H%M%S}"


def stamp_batch(df: DataFrame, run_ts: datetime, batch_id: str | None = None) -> DataFrame:
    """Add ``processed_at`` and ``batch_id``, both from the one run time."""
    return df.withColumns(
        {"processed_at": timestamp_literal(run_ts), "batch_id": F.lit(batch_id or batch_name(run_ts))}
    )


def amount_to_money(df: DataFrame) -> DataFrame:
    """The stored amount. After the filter on purpose: 0.004 is positive and is stored as 0.00."""
    if "amount" not in df.columns:
        return df
    return df.withColumn("amount", parsing.to_money(F.col("amount")))


def parse_transactions(df: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """All typing rules and no filter.

    Columns that are parsed need no mapping of missing values: none of the spellings parses.
    """
    df = df.transform(map_missing_values, [*ID_COLUMNS, *DATE_COLUMNS, "amount"]).transform(parse_ids).transform(parse_dates, formats)
    return df.transform(parse_amount).transform(normalize_status)


def kept_by_rules(df: DataFrame) -> Column:
    """Whether the cleaning rules keep a parsed row; a rule applies if its column is there."""
    kept = F.lit(True)
    if "amount" in df.columns:
        kept = kept & filters.is_positive(F.col("amount"))
    if "status" in df.columns:
        kept = kept & filters.is_valid(F.col("status"))
    return F.coalesce(kept, F.lit(False))


def transform_transactions(
    df: DataFrame, run_ts: datetime, batch_id: str | None = None, formats: Sequence[str] = ()
) -> DataFrame:
    """Type, filter and stamp transaction rows: one stage, no shuffle."""
    df = parse_transactions(df, formats)
    if "amount" in df.columns:
        df = filters.positive_amount(df)
    if "status" in df.columns:
        df = filters.valid_status(df)
    return stamp_batch(amount_to_money(df), run_ts, batch_id)


def column_defaults(df: DataFrame, spec: TableSpec, **overrides) -> DataFrame:
    """Add the columns of ``spec`` that ``df`` omits, with their default or NULL.

    A column that is present stays as it is, NULLs included. ``overrides`` replaces the default of a
    column by a given expression, which is how the load time gets in.
    """
    kinds = dict(spec.columns)
    added = {}
    for name, kind in kinds.items():
        if name in df.columns:
            continue
        value = overrides.get(name)
        if value is None:
            value = F.expr(spec.defaults.get(name, "NULL"))
        added[name] = value.cast("string" if kind.startswith("VARCHAR") else kind)
    return df.withColumns(added) if added else df
