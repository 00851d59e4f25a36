"""The given tables in the shape of the warehouse's inputs.

Every frame covers its whole source table. The dirty values are made by rule from the id, so that
each cleaning rule meets rows it must act on. The SQL texts hold for Spark and for the check alike;
``{STR}``, ``{MICROS}`` and ``{SECONDS}`` stand for what the dialects spell differently.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators import chunks, clean
from tallyworks.plans import transactions, warehouse

RUN_TS = datetime(2024, 2, 1, 6, 0, 0)
LOAD_TS = datetime(2024, 2, 1, 7, 0, 0)
AS_OF = date(2024, 1, 31)
CHUNK_ROWS = 1000
SMALL_CHUNK_ROWS = 100

RAW_SOURCE = """
select event_id as transaction_id,
  case when event_id % 2503 = 7 then null else user_id end as user_id,
  case when event_id % 97 = 1 then 'abc' when event_id % 89 = 1 then '-5.00' when event_id % 83 = 1 then 'NaN'
       when event_id % 79 = 1 then '0' else cast(cast(value as decimal(15,2)) as {STR}) end as amount,
  'USD' as currency,
  case when event_id % 4001 = 9 then 'not-a-date' else {MICROS} end as transaction_date,
  case event_type when 'error' then ' FAILED ' when 'purchase' then 'Completed' when 'view' then 'pending'
       when 'signup' then 'CANCELLED' else 'clicked' end as status
from events"""

LOGS = """
select {SECONDS} as ts_text,
  case when event_id % 61 = 3 then null
       else concat('GET /api/', event_type, '?id=', cast(event_id % 5 as {STR})) end as endpoint,
  case when event_type = 'error' then 500 + cast(event_id % 4 as int)
       when event_id % 3 = 0 then 404 else 200 end as status_code,
  value as response_time,
  concat('user_agent_', cast(event_id % 99 + 1 as {STR}), repeat('x', cast(event_id % 120 as int))) as user_agent,
  case when event_id % 7 = 0 then null else user_id end as user_id,
  event_id
from events"""

USERS = """
select c_custkey as user_id, c_name as user_name, c_mktsegment as user_category, n_name as country,
  date '2020-01-01' as valid_from, date '9999-12-31' as valid_to, c_custkey % 50 <> 0 as is_current
from customer left join nation on c_nationkey = n_nationkey"""

SPARK_DIALECT = {
    "STR": "string",
    "MICROS": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    "SECONDS": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
}
DUCKDB_DIALECT = {
    "STR": "varchar",
    "MICROS": "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
    "SECONDS": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
}


def in_dialect(text: str, dialect: dict[str, str]) -> str:
    for name, value in dialect.items():
        text = text.replace("{" + name + "}", value)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    query = in_dialect(text, SPARK_DIALECT)
    frames = {name: table(spark, sf_dir, name) for name in names}
    for name in names:
        query = query.replace(f"from {name}", f"from {{{name}}}").replace(f"join {name}", f"join {{{name}}}")
    return spark.sql(query, **frames)


def raw_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty transactions, amounts and dates as text."""
    return _run(spark, sf_dir, RAW_SOURCE, "events")


def logs(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """Log records with query strings, NULL endpoints and users, long agents."""
    rows = _run(spark, sf_dir, LOGS, "events").withColumnRenamed("ts_text", "timestamp")
    return rows if with_id else rows.drop("event_id")


def dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, USERS, "customer", "nation")


def dim_date(spark: SparkSession) -> DataFrame:
    return warehouse.default_date_dimension(spark)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions after all cleaning rules."""
    return clean.transform_transactions(raw_source(spark, sf_dir), RUN_TS)


def chunked_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.with_chunk(raw_source(spark, sf_dir), "transaction_id", CHUNK_ROWS)


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned transactions with the chunk of their input position."""
    return clean.transform_transactions(chunked_source(spark, sf_dir), RUN_TS)


def unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows no rule has filtered, the completed ones delivered twice: all checks find something."""
    rows = clean.stamp_batch(clean.amount_to_money(clean.parse_transactions(raw_source(spark, sf_dir))), RUN_TS)
    return rows.unionByName(rows.where(F.col("status") == "completed"))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned transactions in fact form, created when they happened."""
    return transactions.to_fact(cleaned(spark, sf_dir), LOAD_TS, created_at_source="event")
