"""Data quality checks as rows (check, passed, error, details).

The figures of all checks come from a few map-side-combined aggregates put side by side in one row;
the check rows are then built from that row. A check that cannot be planned, say for a missing
column, becomes a failed row that carries the message.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.operators import aggregates
from tallyworks.schemas import VALID_STATUSES

CHECK_ROW = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)

class DataQualityError(ValueError):
    """Raised by the gate; stops the load."""


def _text(c: Column) -> Column:
    return c.cast("string")


def _row(name: str, passed: Column, error: Column, details: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        passed.alias("passed"),
        F.when(~passed, error).alias("error"),
        details.alias("details"),
    )


def _side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """One row out of one-row frames: stacked, then the one value of each column taken."""
    stacked = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _to_rows(figures: DataFrame, checks: Sequence[Column], with_verdict: bool = False) -> DataFrame:
    rows = figures.select(F.array(*checks).alias("checks"))
    if not with_verdict:
        return rows.select(F.inline("checks"))
    verdict = F.forall("checks", lambda c: c["passed"])
    return rows.select(verdict.alias("is_valid"), F.inline("checks")).select(*CHECK_ROW.names, "is_valid")


# The figures each check needs; texts below are fixed values.

def _count_figures(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def _negative_figures(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("amount") < 0).alias("n_negative"))


def _status_figures(df: DataFrame) -> DataFrame:
    """Number of different invalid statuses and of their rows; aggregates.invalid_status_counts has the pairs as rows."""
    counts = aggregates.invalid_status_counts(df)
    return counts.agg(F.count("*").alias("n_invalid"), F.coalesce(F.sum("count"), F.lit(0)).alias("n_invalid_rows"))


def _duplicate_figures(df: DataFrame) -> DataFrame:
    return aggregates.duplicate_keys(df).agg(F.count("*").alias("n_duplicates"))


def _not_empty(table_name: str) -> Column:
    n = F.col("n_rows")
    return _row(
        f"{table_name} not empty",
        n > 0,
        F.lit(f"Table {table_name} is empty"),
        F.concat(F.lit("Row count: "), _text(n)),
    )


def _no_negative() -> Column:
    n = F.col("n_negative")
    return _row(
        "No negative amounts",
        n == 0,
        F.concat(F.lit("Found "), _text(n), F.lit(" transactions with negative amounts")),
        F.concat(F.lit("Negative amount count: "), _text(n)),
    )


def _valid_statuses() -> Column:
    n = F.col("n_invalid")
    return _row(
        "Valid statuses",
        n == 0,
        F.concat(F.lit("Found invalid statuses: "), _text(n), F.lit(" different values in "), _text(F.col("n_invalid_rows")), F.lit(" rows")),
        F.concat(F.lit("Invalid status count: "), _text(n)),
    )


def _no_duplicates() -> Column:
    n = F.col("n_duplicates")
    return _row(
        "No duplicate transactions",
        n == 0,
        F.concat(F.lit("Found "), _text(n), F.lit(" duplicate transactions")),
        F.concat(F.lit("Duplicate count: "), _text(n)),
    )


def _failed_row(df: DataFrame, name: str, error: Exception) -> DataFrame:
    return df.sparkSession.createDataFrame([(name, False, str(error), None)], CHECK_ROW)


def _guarded(df: DataFrame, name: str, figures: Callable[[DataFrame], DataFrame], row: Column) -> DataFrame:
    try:
        return _to_rows(figures(df), [row])
    except PySparkException as error:
        return _failed_row(df, name, error)


def check_not_empty(df: DataFrame, table_name: str = "raw_transactions") -> DataFrame:
    return _guarded(df, f"{table_name} not empty", _count_figures, _not_empty(table_name))


def check_no_negative(df: DataFrame) -> DataFrame:
    return _guarded(df, "No negative amounts", _negative_figures, _no_negative())


def check_valid_status(df: DataFrame) -> DataFrame:
    return _guarded(df, "Valid statuses", _status_figures, _valid_statuses())


def check_no_duplicates(df: DataFrame) -> DataFrame:
    return _guarded(df, "No duplicate transactions", _duplicate_figures, _no_duplicates())


def quality_report(df: DataFrame, table_name: str = "raw_transactions") -> DataFrame:
    """The four checks with the overall verdict ``is_valid`` on every row.

    One pass for the plain counts and one each for statuses and keys, every pass reading only the
    columns it needs.
    """
    try:
        counts = df.agg(
            F.count("*").alias("n_rows"), F.count_if(F.col("amount") < 0).alias("n_negative")
        )
        figures = _side_by_side([counts, _status_figures(df), _duplicate_figures(df)])
        rows = [_not_empty(table_name), _no_negative(), _valid_statuses(), _no_duplicates()]
        return _to_rows(figures, rows, with_verdict=True)
    except PySparkException:
        checks = [check_not_empty(df, table_name), check_no_negative(df), check_valid_status(df), check_no_duplicates(df)]
        rows = functools.reduce(DataFrame.unionByName, checks)
        # At least one check could not even be planned, so the verdict is known.
        return rows.withColumn("is_valid", F.lit(False))


# The same verdict from figures that merge: rows (batch_id, kind, value, n), which of a new batch alone can be added.

PARTIALS = "batch_id string, kind string, value string, n bigint"


def batch_partials(rows: DataFrame) -> DataFrame:
    """Figures of the batches of ``rows``, but for repeated ids: numbers of rows, of negative amounts, of NULL ids, and of
    rows with each invalid status. One grouping, combined before the shuffle."""
    invalid = F.when(~F.col("status").isin(*VALID_STATUSES), F.col("status"))
    per_status = rows.groupBy("batch_id", invalid.alias("value")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("amount") < 0).alias("negative"), F.count_if(F.col("transaction_id").isNull()).alias("null id")
    )
    nothing = F.lit(None).cast("string")
    kinds = [F.struct(F.lit(k).alias("kind"), nothing.alias("value"), F.col(k).alias("n")) for k in ("rows", "negative", "null id")]
    kinds.append(F.struct(F.lit("status").alias("kind"), "value", F.when(F.col("value").isNotNull(), F.col("rows")).otherwise(0).alias("n")))
    return per_status.select("batch_id", F.inline(F.array(*kinds))).where("n > 0")


def repeated_partials(ids: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows of ``ids`` (``key``, ``batch_id``, ``n``) whose key is one of ``repeated``."""
    return ids.join(repeated, "key", "left_semi").select("batch_id", F.lit("repeated").alias("kind"), F.col("key").cast("string").alias("value"), "n")


def merged_report(partials: DataFrame, table_name: str = "raw_transactions") -> DataFrame:
    """``quality_report`` of a table from the figures of its batches; an id is repeated if its batches hold it more than once."""
    values = partials.groupBy("kind", "value").agg(F.sum("n").alias("n"))
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    figures = values.agg(
        total("rows").alias("n_rows"), total("negative").alias("n_negative"), total("status").alias("n_invalid_rows"),
        F.count_if(F.col("kind") == "status").alias("n_invalid"),
        F.count_if(F.col("kind").isin("repeated", "null id") & (F.col("n") > 1)).alias("n_duplicates"),
    )
    return _to_rows(figures, [_not_empty(table_name), _no_negative(), _valid_statuses(), _no_duplicates()], with_verdict=True)


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed")).select(*CHECK_ROW.names)


def _as_dict(rows: Sequence[Any]) -> dict[str, Any]:
    checks = [{name: row[name] for name in CHECK_ROW.names} for row in rows]
    return {
        "is_valid": all(c["passed"] for c in checks),
        "checks": checks,
        "errors": [c["error"] for c in checks if not c["passed"]],
    }


def report_dict(report: DataFrame) -> dict[str, Any]:
    """is_valid, checks and errors of a report, which has a row per check."""
    return _as_dict(report.collect())


def _collect_each(frames: Sequence[tuple[str, DataFrame]]) -> list[dict[str, Any]]:
    rows = []
    for name, frame in frames:
        try:
            rows += [r.asDict() for r in frame.collect()]
        except PySparkException as error:
            rows.append({"check": name, "passed": False, "error": str(error), "details": None})
    return rows


def validate_transactions(df: DataFrame, table_name: str = "raw_transactions") -> dict[str, Any]:
    """Run the report: is_valid, checks and errors. A check that fails to run counts as failed."""
    try:
        return report_dict(quality_report(df, table_name))
    except PySparkException:
        return _as_dict(
            _collect_each(
                [
                    (f"{table_name} not empty", check_not_empty(df, table_name)),
                    ("No negative amounts", check_no_negative(df)),
                    ("Valid statuses", check_valid_status(df)),
                    ("No duplicate transactions", check_no_duplicates(df)),
                ]
            )
        )


def gate(df: DataFrame, table_name: str = "raw_transactions") -> dict[str, Any]:
    """Raise if the table is not valid; return the report otherwise."""
    return require_valid(validate_transactions(df, table_name))


def gate_report(report: DataFrame) -> dict[str, Any]:
    """The same of a report's rows."""
    return require_valid(report_dict(report))


def require_valid(result: dict[str, Any]) -> dict[str, Any]:
    if not result["is_valid"]:
        raise DataQualityError(
            f"Data quality validation failed: {result['errors']}; invalid_status_counts lists invalid statuses as rows"
        )
    return result


# Declarative checks on any table.

def _spec_name(spec: dict[str, Any]) -> str:
    columns = spec.get("columns") or ([spec["column"]] if "column" in spec else [])
    return f"{spec['type']}({', '.join(columns)})" if columns else spec["type"]


def _violation(spec: dict[str, Any]) -> Column:
    """Condition for one row to break a row-level check; NULL passes, except for not_null."""
    c = F.col(spec["column"])
    if spec["type"] == "not_null":
        return c.isNull()
    if spec["type"] == "accepted_values":
        return ~c.isin(*spec["values"])
    if spec["type"] == "range":
        low, high = spec.get("min"), spec.get("max")
        below = c < low if low is not None else F.lit(False)
        above = c > high if high is not None else F.lit(False)
        return below | above
    raise ValueError(f"unknown check type: {spec['type']}")


def run_check_rows(df: DataFrame, specs: Sequence[dict[str, Any]]) -> DataFrame:
    """Check rows for a list of specs, in one aggregate plus one grouping per unique key.

    Specs: ``{'type': 'not_empty'}``, ``{'type': 'range', 'column', 'min', 'max'}``,
    ``{'type': 'accepted_values', 'column', 'values'}``, ``{'type': 'not_null', 'column'}`` and
    ``{'type': 'unique', 'columns'}``.
    """
    if not specs:
        return df.sparkSession.createDataFrame([], CHECK_ROW)
    scalars, groupings, rows = [], [], []
    for i, spec in enumerate(specs):
        n = F.col(f"n{i}")
        name = _spec_name(spec)
        if spec["type"] == "not_empty":
            scalars.append(F.count("*").alias(f"n{i}"))
            rows.append(_row(name, n > 0, F.lit("no rows"), F.concat(F.lit("rows: "), _text(n))))
            continue
        if spec["type"] == "unique":
            keys = list(spec.get("columns") or [spec["column"]])
            repeated = df.groupBy(*keys).agg(F.count("*").alias("size")).where(F.col("size") > 1)
            groupings.append(repeated.agg(F.count("*").alias(f"n{i}")))
            what = " repeated keys"
        else:
            scalars.append(F.count_if(_violation(spec)).alias(f"n{i}"))
            what = " rows violate the check"
        rows.append(
            _row(
                name,
                n == 0,
                F.concat(F.lit(f"{name}: "), _text(n), F.lit(what)),
                F.concat(F.lit("violations: "), _text(n)),
            )
        )
    parts = ([df.agg(*scalars)] if scalars else []) + groupings
    return _to_rows(_side_by_side(parts), rows)


def run_checks(df: DataFrame, specs: Sequence[dict[str, Any]]) -> dict[str, Any]:
    """Run declarative checks: success, errors and checks."""
    try:
        rows = [r.asDict() for r in run_check_rows(df, specs).collect()]
    except PySparkException:
        rows = []
        for spec in specs:
            try:
                rows += _collect_each([(_spec_name(spec), run_check_rows(df, [spec]))])
            except PySparkException as error:
                rows.append({"check": _spec_name(spec), "passed": False, "error": str(error), "details": None})
    result = _as_dict(rows)
    return {"success": result["is_valid"], "errors": result["errors"], "checks": result["checks"]}


def require_checks(df: DataFrame, specs: Sequence[dict[str, Any]]) -> dict[str, Any]:
    """Run declarative checks and raise if one fails; return their result otherwise."""
    result = run_checks(df, specs)
    if not result["success"]:
        raise DataQualityError(f"Checks failed: {result['errors']}")
    return result


ACCEPTED_STATUS_CHECK = {"type": "accepted_values", "column": "status", "values": list(VALID_STATUSES)}
