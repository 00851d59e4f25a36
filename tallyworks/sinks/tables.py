"""Writes to catalog tables, by column name."""

from __future__ import annotations

import logging
import re
import urllib.parse
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.operators import integrity
from tallyworks.schemas import KEY_PROPERTY, LEDGER_PROPERTY, REQUIRED_PROPERTY, TableSpec
from tallyworks.session import remove, scratch, subfolders, written
from tallyworks.sinks import claims
from tallyworks.sinks.ledger import KeyLedger, location

logger = logging.getLogger(__name__)

JDBC_BATCH_ROWS = 1000  # fixed value: rows per INSERT


def _fitting(value: Column, kind: T.StructField) -> Column:
    """The value, or an error if it is longer than the column's VARCHAR allows."""
    limit = re.fullmatch(r"varchar\((\d+)\)", kind.metadata.get("__CHAR_VARCHAR_TYPE_STRING", ""))
    if not limit:
        return value
    message = f"EXCEED_LIMIT_LENGTH: a value of {kind.name} is longer than {limit[1]}"
    return F.when(F.length(value) > int(limit[1]), F.raise_error(message).cast(kind.dataType)).otherwise(value)


def align_to_table(df: DataFrame, table: str) -> DataFrame:
    """The columns of ``table`` in its order: a column ``df`` lacks gets its default or NULL.

    A column the table does not know is an error. A column that is present keeps its NULLs.
    """
    fields = df.sparkSession.table(table).schema.fields
    known = {f.name for f in fields}
    unknown = [c for c in df.columns if c not in known]
    if unknown:
        raise ValueError(f"table {table} has no column {', '.join(unknown)}")
    columns = []
    for f in fields:
        if f.name in df.columns:
            columns.append(_fitting(F.col(f.name).cast(f.dataType), f).alias(f.name))
        else:
            default = f.metadata.get("CURRENT_DEFAULT", "NULL")
            columns.append(F.expr(default).cast(f.dataType).alias(f.name))
    return df.select(*columns)


def _insert(rows: DataFrame, table: str, mode: str) -> int:
    """Write and return the number of rows, which the write itself counts (-1 should it not have)."""
    counted = Observation()
    rows.observe(counted, F.count("*").alias("n")).write.mode(mode).insertInto(table)
    n = counted.get.get("n", -1)
    logger.info("wrote %d rows to %s", n, table)
    return n


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def stored_batches(spark: SparkSession, table: str) -> list[str]:
    """Batch folders of a table partitioned by ``batch_id``, one per run, from the catalog."""
    names = (r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return [urllib.parse.unquote(n.removeprefix("batch_id=")) for n in names]


def key_of(spark: SparkSession, table: str) -> tuple[list[str], list[str]]:
    """Key and NOT NULL columns the table was created with, which Spark itself does not keep."""
    found = _properties(spark, table)
    columns = lambda name: [c for c in found.get(name, "").split(",") if c]
    return columns(KEY_PROPERTY), columns(REQUIRED_PROPERTY)


def check_constraints(rows: DataFrame, table: str) -> None:
    """Raise if rows to append have a NULL where the table has none, or repeat a key among them or in the table.

    Only the new keys are grouped and looked up; tables without a recorded key cost nothing.
    """
    if key := check_rows(rows, table):
        target = rows.sparkSession.table(table).select(*key)
        if not rows.select(*key).join(target, key, "left_semi").isEmpty():
            raise integrity.IntegrityError(f"({', '.join(key)}) exists in {table} already")


def check_rows(rows: DataFrame, table: str) -> list[str]:
    """The part of the check that needs the rows only; returns the key."""
    key, required = key_of(rows.sparkSession, table)
    nulls = [c for c in required if c in rows.columns]
    if nulls:
        found = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in nulls]).first().asDict()
        if bad := [c for c, n in found.items() if n]:
            raise integrity.IntegrityError(f"NULL in {', '.join(bad)} of {table}")
    if key:
        integrity.require_unique(rows, key)
    return key


def append(df: DataFrame, table: str, cluster_by: str | None = None, checked: bool = False) -> int:
    """Append rows. ``cluster_by`` gathers the rows of a partition value into few files.

    The rebalance hint lets AQE split a value that holds much of the data over several tasks. A recorded key and NOT
    NULL columns are checked first, unless the caller has ``checked`` the rows. A table that keeps a ledger of its keys
    (``keep_key_ledger``) is not read for that, and appends to it exclude each other.
    """
    rows = align_to_table(df, table)
    spread = (lambda r: r.hint("rebalance", F.col(cluster_by))) if cluster_by else (lambda r: r)
    if not checked and keeps_ledger(df.sparkSession, table):
        return _append_with_ledger(rows, table, spread)
    if not checked:
        check_constraints(rows, table)
    return _insert(spread(rows), table, "append")


# A ledger of a table's keys beside it, so that an append need not read the table.

def keeps_ledger(spark: SparkSession, table: str) -> bool:
    return LEDGER_PROPERTY in _properties(spark, table)


def _digest(rows: DataFrame, key: list[str]) -> Column:
    """The key as a whole number: itself, or a hash. Rows that meet in a hash are compared by their keys."""
    whole = len(key) == 1 and isinstance(rows.schema[key[0]].dataType, T.IntegralType)
    return (F.col(key[0]).cast("bigint") if whole else F.xxhash64(*key)).alias("key")


def keep_key_ledger(spark: SparkSession, table: str) -> None:
    """From now on keep a ledger of the keys of a table with a recorded key; what the table holds is read once."""
    key, _ = key_of(spark, table)
    if not key:
        raise ValueError(f"{table} has no recorded key")
    with claims.claim(spark, f"{location(spark, table)}_append_claims"):
        if not keeps_ledger(spark, table):
            KeyLedger(spark, table, "key_ledger").add(_entries(spark.table(table), key))
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LEDGER_PROPERTY}' = 'key_ledger')")


def _entries(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.select(_digest(rows, key), F.lit("").alias("batch_id"), F.lit(1).cast("bigint").alias("n"))


def _append_with_ledger(rows: DataFrame, table: str, spread) -> int:
    """Look the new keys up in the ledger; only rows that meet an entry there are looked up in the table itself.

    Keys are entered before the rows are stored. Should the job be lost in between, the entries have no rows, which the
    look-up in the table finds out when the append is repeated.
    """
    spark = rows.sparkSession
    key, _ = key_of(spark, table)
    with claims.claim(spark, f"{location(spark, table)}_append_claims") as held, scratch(spark, "append") as folder:
        rows = written(rows, f"{folder}/rows")
        check_rows(rows, table)
        ledger = KeyLedger(spark, table, "key_ledger")
        met = ledger.known(_entries(rows, key))
        if met is not None:
            met = written(met.select("key").distinct(), f"{folder}/met")
            if not met.isEmpty():
                suspects = rows.withColumn("_met", _digest(rows, key)).join(met.withColumnRenamed("key", "_met"), "_met", "left_semi").select(*key)
                if not suspects.join(spark.table(table).select(*key), key, "left_semi").isEmpty():
                    raise integrity.IntegrityError(f"({', '.join(key)}) exists in {table} already")
        held.require()
        ledger.add(_entries(rows, key))
        return _insert(spread(rows), table, "append")


def quoted(value: str) -> str:
    """An SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def overwrite_batch(df: DataFrame, table: str, batch_id: str) -> int:
    """Replace one batch of a parquet table partitioned by ``batch_id``.

    The rows are written to a folder of their own, and the table's partition is then pointed at it. So the old rows
    stay until the new ones are complete, and no other batch can be touched, whatever the session's overwrite mode and
    whoever writes another batch meanwhile. A row of another batch is an error. A run that yields no rows removes the
    batch.
    """
    spark = df.sparkSession
    rows = align_to_table(df, table)
    own = F.col("batch_id").eqNullSafe(F.lit(batch_id))
    rows = rows.where(F.assert_true(own, F.lit(f"a row does not belong to batch {batch_id}")).isNull()).drop("batch_id")
    home, version = f"{location(spark, table)}/batch_id={urllib.parse.quote(batch_id, safe='')}", uuid.uuid4().hex
    counted = Observation()
    try:
        rows.observe(counted, F.count("*").alias("n")).write.parquet(f"{home}/{version}")
    except Exception:
        remove(spark, f"{home}/{version}")
        raise
    n = counted.get.get("n", -1)
    partition = f"PARTITION (batch_id = {quoted(batch_id)})"
    if n == 0:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {partition}")
    else:
        place = quoted(f"{home}/{version}")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition} LOCATION {place}")
        spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION {place}")
    for old in subfolders(spark, home):
        if old != version or n == 0:
            remove(spark, f"{home}/{old}")
    spark.catalog.refreshTable(table)
    logger.info("wrote %d rows to batch %s of %s", n, batch_id, table)
    return n


def drop_batch(spark: SparkSession, table: str, batch_id: str) -> None:
    """Remove one batch of a table partitioned by ``batch_id``, with what a job that was lost left in its folder."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (batch_id = {quoted(batch_id)})")
    remove(spark, f"{location(spark, table)}/batch_id={urllib.parse.quote(batch_id, safe='')}")
    spark.catalog.refreshTable(table)


def save(df: DataFrame, table: str, if_exists: str = "append") -> None:
    """Write a frame to a table that may not exist yet: append, fail or replace."""
    if if_exists == "append" and df.sparkSession.catalog.tableExists(table):
        append(df, table)
        return
    modes = {"append": "append", "fail": "error", "replace": "overwrite"}
    df.write.mode(modes[if_exists]).format("parquet").saveAsTable(table)


def create_from_df(df: DataFrame, table: str, primary_key: str | None = None, key_ledger: bool = False) -> None:
    """Create an empty table with the columns of ``df``; an existing table is an error.

    A primary key is recorded with the table and checked by every append, with ``key_ledger`` against a ledger of the
    keys instead of the table.
    """
    df.limit(0).write.mode("error").format("parquet").saveAsTable(table)
    if primary_key and primary_key in df.columns:
        properties = f"{quoted(KEY_PROPERTY)} = {quoted(primary_key)}, {quoted(REQUIRED_PROPERTY)} = {quoted(primary_key)}"
        df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({properties})")
        if key_ledger:
            keep_key_ledger(df.sparkSession, table)


def create_tables(spark, specs: tuple[TableSpec, ...], database: str | None = None) -> None:
    for spec in specs:
        spark.sql(spec.create_sql(database))


def append_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Append to a table of an outside database, each partition over its own connection."""
    df.write.jdbc(url, table, mode="append", properties={"batchsize": str(JDBC_BATCH_ROWS), **properties})
