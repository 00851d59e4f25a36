"""Acceptance of input by chunk: one bad row rejects the whole chunk it came in.

A chunk is a range of input positions (from an ordinal column the caller names), a source file, or
a single row. Rejected chunks are found by an aggregate that combines on the map side and are then
joined away; a window over the chunk would instead bring every row of a chunk into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.schemas import REQUIRED_COLUMNS

CHUNK_ROWS = 10_000  # fixed value: rows per chunk
CHUNK_COLUMN = "chunk_id"


def chunk_of(ordinal: Column, chunk_rows: int = CHUNK_ROWS) -> Column:
    """Chunk number of an input position, counted before any filter."""
    number = ordinal.cast("bigint")
    size = F.lit(chunk_rows).cast("bigint")
    return F.call_function("div", number - F.pmod(number, size), size)  # whole numbers only; rounds down below zero, too


def with_chunk(df: DataFrame, ordinal: str | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add the chunk: a range of the ordinal column, or the file a row was read from."""
    unit = chunk_of(F.col(ordinal).try_cast("bigint"), chunk_rows) if ordinal else F.col("_metadata.file_path")
    return df.select("*", unit.alias(CHUNK_COLUMN))


def _missing(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _any_null(required: Sequence[str]) -> Column:
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    return bad


def rejected_chunks(
    clean: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, chunk: str = CHUNK_COLUMN
) -> DataFrame:
    """Chunks with a NULL in a required column: chunk, number of NULLs per column, reason."""
    totals = (
        clean.where(_any_null(required))
        .groupBy(chunk)
        .agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in required])
    )
    parts = [
        F.when(F.col(f"{c}_nulls") > 0, F.concat(F.lit(f"{c}: "), F.col(f"{c}_nulls").cast("string")))
        for c in required
    ]
    return totals.withColumn("reason", F.concat(F.lit("null values in "), F.concat_ws(", ", *parts)))


def _split(clean: DataFrame, rejected: DataFrame, chunk: str) -> tuple[DataFrame, DataFrame]:
    bad = rejected.select(F.col(chunk).alias("_bad_chunk"), "reason")
    same = F.col(chunk).eqNullSafe(F.col("_bad_chunk"))
    return clean.join(bad, same, "left_anti"), clean.join(bad, same).drop("_bad_chunk")


def split_chunks(
    clean: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    chunk: str = CHUNK_COLUMN,
    unit: str = "chunk",
    rejected: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and the other rows with the reason they were rejected for.

    ``unit='row'`` judges each row alone. A job can compute ``rejected_chunks`` once, write them down
    and pass them in: the join then rests on their true size, and falls away if there are none.
    """
    missing = _missing(clean, required)
    if missing:
        reason = F.lit(f"missing required columns: {', '.join(missing)}")
        return clean.where(F.lit(False)), clean.withColumn("reason", reason)
    if unit == "row":
        nulls = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
        return (
            clean.where(~_any_null(required)),
            clean.where(_any_null(required)).withColumn("reason", F.concat(F.lit("null values in "), nulls)),
        )
    if rejected is None:
        return _split(clean, rejected_chunks(clean, required, chunk), chunk)
    if rejected.isEmpty():
        return clean, clean.where(F.lit(False)).withColumn("reason", F.lit(None).cast("string"))
    return _split(clean, rejected, chunk)


def validate_chunks(clean: DataFrame, **options) -> DataFrame:
    """Rows of the accepted chunks."""
    return split_chunks(clean, **options)[0]


def quarantine_rows(clean: DataFrame, **options) -> DataFrame:
    """Rows of the rejected chunks, with the reason."""
    return split_chunks(clean, **options)[1]


def chunk_report(
    source: DataFrame, clean: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, chunk: str = CHUNK_COLUMN
) -> DataFrame:
    """One row per input chunk: rows read, rows left after cleaning, acceptance.

    A chunk nothing is left of counts as rejected, although it has no rows to keep back.
    """
    read = source.select(chunk, F.lit(1).alias("i"), F.lit(0).alias("k"), F.lit(0).alias("b"))
    kept = clean.select(chunk, F.lit(0).alias("i"), F.lit(1).alias("k"), _any_null(required).cast("int").alias("b"))
    totals = (
        read.unionByName(kept)
        .groupBy(chunk)
        .agg(F.sum("i").alias("input_rows"), F.sum("k").alias("kept_rows"), F.sum("b").alias("bad_rows"))
    )
    return totals.withColumn("accepted", (F.col("kept_rows") > 0) & (F.col("bad_rows") == 0))
