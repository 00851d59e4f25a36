"""Constraints of the fact table, which Spark does not enforce: NOT NULL, unique id, foreign keys.

Each key-based rule is reduced to the set of offending keys first. Those sets hold a key once, so
joining them back cannot multiply rows, and as a rule they are small enough for the planner to
broadcast; if not, the shuffle join is split by AQE where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators import joins
from tallyworks.operators.aggregates import duplicate_keys
from tallyworks.schemas import FACT_TRANSACTIONS


class IntegrityError(ValueError):
    """Raised in ``fail`` mode; nothing is loaded."""


def _flag(keys: DataFrame, name: str) -> DataFrame:
    return keys.withColumn(name, F.lit(True))


def offending_keys(
    fact: DataFrame, dim_users: DataFrame, dim_date: DataFrame, target: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Per key-based rule the keys that break it, each once; the column of a frame is the key."""
    key = "transaction_id"
    sets = {"duplicate transaction_id": duplicate_keys(fact.where(F.col(key).isNotNull()), key).select(key)}
    if target is not None:
        sets["transaction_id already loaded"] = joins.existing_keys(fact, target, key)
    sets["unknown user_id"] = joins.missing_parents(fact, dim_users, "user_id")
    sets["unknown date_id"] = joins.missing_parents(fact, dim_date, "date_id")
    return sets


def flag_violations(fact: DataFrame, offending: dict[str, DataFrame]) -> DataFrame:
    """Add ``violations``, the names of all broken constraints; empty for a good row.

    A rule that no key breaks may be left out of ``offending``; it then costs no join.
    """
    flagged = fact
    names = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in FACT_TRANSACTIONS.required]
    for i, (text, keys) in enumerate(offending.items()):
        flagged = flagged.join(_flag(keys, f"_broken{i}"), keys.columns[0], "left")
        names.append(F.when(F.col(f"_broken{i}"), F.lit(text)))
    return flagged.select(*fact.columns, F.array_compact(F.array(*names)).alias("violations"))


def with_violations(
    fact: DataFrame, dim_users: DataFrame, dim_date: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """Fact rows with all their violations, as one lazy plan."""
    return flag_violations(fact, offending_keys(fact, dim_users, dim_date, target))


def violating(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("violations") > 0)


def passing(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("violations") == 0).drop("violations")


def violation_counts(flagged: DataFrame) -> DataFrame:
    """Rows per kind of violation; there are only a handful of kinds."""
    return flagged.select(F.explode("violations").alias("violation")).groupBy("violation").agg(
        F.count("*").alias("row_count")
    )


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Primary key of a table being created: no NULL and no repeated key."""
    bad = df.groupBy(*keys).agg(F.count("*").alias("n"))
    null_key = F.lit(False)
    for c in keys:
        null_key = null_key | F.col(c).isNull()
    if not bad.where((F.col("n") > 1) | null_key).isEmpty():
        raise IntegrityError(f"({', '.join(keys)}) is not a key: repeated or NULL values")
