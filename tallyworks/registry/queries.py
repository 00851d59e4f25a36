"""One query per operator over the given tables; each takes (spark, sf_dir)."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import aggregates as fa
from tallyworks.functions import dates, parsing
from tallyworks.operators import aggregates, chunks, clean, filters, integrity, joins, quality, sorting
from tallyworks.plans import daily, logs, reports, transactions, verdicts, warehouse
from tallyworks.registry import adapters as a
from tallyworks.schemas import FACT_TRANSACTIONS, LOG_RECORD
from tallyworks.session import configure, shared_dir
from tallyworks.sinks import files, tables
from tallyworks.sources import logs_json
from tallyworks.sources.tables import run_query, table_exists
from tallyworks.sources.transactions_csv import read_values
from tallyworks.streaming import hours
from tallyworks.streaming import transactions as transaction_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT_DATE = "2024-01-16"
LAST_KNOWN_DATE = date(2024, 1, 20)
CHECKS = [
    {"type": "not_empty"},
    {"type": "range", "column": "amount", "min": 0, "max": 100},
    quality.ACCEPTED_STATUS_CHECK,
    {"type": "not_null", "column": "user_id"},
    {"type": "unique", "columns": ["transaction_id"]},
]


def query(fn: Query) -> Query:
    """Register a function under its own name."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _dbl(name: str):
    return F.col(name).cast("double").alias(name)


def _database(spark: SparkSession) -> str:
    """A new database in the shared folder."""
    name = f"tallyworks_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, name)}'")
    return name


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def _csv_of_raw(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "csv")
    _write_csv(a.raw_source(spark, sf_dir), path)
    return path


def _log_files(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "logs")
    a.logs(spark, sf_dir).write.option("compression", "gzip").json(path)
    return path


def _log_files_with_bad_lines(spark: SparkSession, sf_dir: str) -> str:
    """The log lines plus, for every sign-up, a cut line, a blank one and other lines to skip."""
    path = shared_dir(spark, "mixed-logs")
    rows = a.logs(spark, sf_dir)
    line = F.to_json(F.struct(*[F.col(c) for c in LOG_RECORD.names]))
    bad = F.array(
        F.substring(line, 1, 20), F.lit(""), F.lit("bad line"), F.lit("5"), F.lit('{"status_code":"x"}'),
        F.concat(line, F.lit(" trailing")),
    )
    good_lines = rows.select(line.alias("value"))
    bad_lines = rows.where(F.col("endpoint").contains("signup")).select(F.explode(bad).alias("value"))
    good_lines.unionByName(bad_lines).write.option("compression", "gzip").text(path)
    return path


def _raw_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id", "user_id", _dbl("amount"), "currency", "transaction_date", "status", "processed_at",
        "batch_id",
    )


def _fact_columns(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", "user_id", "date_id", _dbl("amount"), "currency", "status", "processed_at")


def _summary_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "hour", "endpoint", "error_count", F.round("avg_response_time", 6).alias("avg_response_time"),
        "max_response_time", "min_response_time", "unique_users",
    )


def _error_row_columns(df: DataFrame) -> DataFrame:
    return df.select("timestamp", "hour", "endpoint", "status_code", "response_time", "user_agent", "user_id")


# Sources, sinks, tables


@query
def src_csv_transactions(spark, sf):
    return read_values(spark, _csv_of_raw(spark, sf)).drop(chunks.CHUNK_COLUMN)


@query
def src_jsonl_logs(spark, sf):
    return logs_json.read_logs(spark, _log_files(spark, sf))


@query
def src_jsonl_tolerant(spark, sf):
    return logs_json.read_logs_tolerant(spark, _log_files_with_bad_lines(spark, sf))


@query
def src_sql_query(spark, sf):
    text = (
        "select user_id, count(*) as n_rows, cast(sum(amount) as double) as total from {tw_fact} "
        "where status = :status and created_at >= cast(:since as timestamp_ntz) group by user_id"
    )
    return run_query(spark, text, {"status": "completed", "since": "2024-01-10"}, {"tw_fact": a.fact(spark, sf)})


@query
def sink_table_append(spark, sf):
    table = f"{_database(spark)}.transactions"
    rows = a.cleaned(spark, sf)
    tables.save(rows.where(F.col("status") == "completed"), table)
    tables.save(rows.where(F.col("status") != "completed"), table)
    return _raw_columns(spark.table(table))


@query
def sink_parquet_summary(spark, sf):
    path = shared_dir(spark, "summary")
    summary = logs.summarize_errors(a.logs(spark, sf))
    files.write_summary(summary, path)
    files.write_summary(summary, path)
    return _summary_columns(spark.read.parquet(path))


@query
def sink_parquet_chunks(spark, sf):
    path = shared_dir(spark, "chunks")
    rows = logs.error_rows(a.logs(spark, sf, with_id=True))
    rows = rows.withColumn("chunk_id", chunks.chunk_of(F.col("event_id"), a.CHUNK_ROWS))
    files.write_chunks(rows, path, "chunk_id")
    back = spark.read.schema(rows.schema).parquet(path)
    return back.select(*_error_row_columns(back).columns, "chunk_id")


@query
def tbl_exists(spark, sf):
    database = _database(spark)
    tables.save(a.cleaned(spark, sf), f"{database}.loaded")
    counts = aggregates.row_count(spark.table(f"{database}.loaded"))
    found = [
        counts.select(
            F.lit(name).alias("table_name"),
            F.lit(table_exists(spark, f"{database}.{name}")).alias("table_exists"),
            F.when(F.lit(name == "loaded"), F.col("row_count")).alias("row_count"),
        )
        for name in ("loaded", "not_there")
    ]
    return found[0].unionByName(found[1])


@query
def tbl_create_from_df(spark, sf):
    table = f"{_database(spark)}.transactions"
    rows = a.cleaned(spark, sf)
    tables.create_from_df(rows, table, primary_key="transaction_id", key_ledger=True)
    tables.append(rows.where(F.col("status") == "completed"), table)
    tables.append(rows.where(F.col("status") != "completed"), table)
    return _raw_columns(spark.table(table))


@query
def ddl_star_schema(spark, sf):
    database = _database(spark)
    warehouse.create_star_schema(spark, database)
    warehouse.create_star_schema(spark, database)
    tables.append(a.dim_users(spark, sf), f"{database}.dim_users")
    warehouse.load_dim_date(spark, f"{database}.dim_date", warehouse.dates_spanning(a.table(spark, sf, "events"), "ts"))
    tables.append(a.cleaned(spark, sf), f"{database}.raw_transactions")
    five = a.fact(spark, sf).select(*FACT_TRANSACTIONS.required).dropna()  # the table takes no NULL in these
    tables.append(five, f"{database}.fact_transactions", cluster_by="date_id")
    rows = []
    for name, defaulted in (("dim_date", "day_name"), ("dim_users", "created_at"),
                            ("fact_transactions", "currency"), ("raw_transactions", "created_at")):
        t = spark.table(f"{database}.{name}")
        rows.append(
            t.agg(F.count("*").alias("row_count"), F.count(defaulted).alias("filled")).select(
                F.lit(name).alias("table_name"), F.lit(len(t.columns)).alias("n_columns"), "row_count", "filled"
            )
        )
    return functools.reduce(DataFrame.unionByName, rows)


# Projections


@query
def proj_parse_dates(spark, sf):
    return clean.parse_dates(a.raw_source(spark, sf)).select("transaction_id", "transaction_date")


@query
def proj_parse_amount(spark, sf):
    return clean.parse_amount(a.raw_source(spark, sf)).select("transaction_id", "amount")


@query
def proj_normalize_status(spark, sf):
    return clean.normalize_status(a.raw_source(spark, sf)).select("transaction_id", "status")


@query
def proj_batch_stamp(spark, sf):
    return clean.stamp_batch(a.raw_source(spark, sf), a.RUN_TS).select("transaction_id", "processed_at", "batch_id")


@query
def proj_log_timestamp(spark, sf):
    return a.logs(spark, sf, with_id=True).select("event_id", parsing.log_timestamp(F.col("timestamp")).alias("ts"))


@query
def proj_log_timestamp_infer(spark, sf):
    rows = a.logs(spark, sf, with_id=True)
    return rows.select("event_id", parsing.log_timestamp_infer(F.col("timestamp")).alias("ts"))


@query
def proj_endpoint_path(spark, sf):
    rows = a.logs(spark, sf, with_id=True)
    return rows.select("event_id", parsing.endpoint_path(F.col("endpoint")).alias("endpoint_clean"))


@query
def proj_user_agent(spark, sf):
    rows = a.logs(spark, sf, with_id=True)
    return rows.select("event_id", parsing.short_user_agent(F.col("user_agent")).alias("user_agent_clean"))


@query
def proj_hour_trunc(spark, sf):
    return a.table(spark, sf, "events").select("event_id", dates.hour_floor(F.col("ts")).alias("hour"))


@query
def proj_date_key(spark, sf):
    return a.table(spark, sf, "orders").select("o_orderkey", dates.date_key(F.col("o_orderdate")).alias("date_id"))


@query
def proj_date_parts(spark, sf):
    return a.table(spark, sf, "orders").select("o_orderkey", *dates.date_parts(F.col("o_orderdate")))


@query
def proj_weekend_flag(spark, sf):
    return a.table(spark, sf, "orders").select("o_orderkey", dates.is_weekend(F.col("o_orderdate")).alias("is_weekend"))


@query
def proj_column_defaults(spark, sf):
    rows = a.cleaned(spark, sf).select("transaction_id", "user_id", "amount", "status")
    rows = rows.withColumn("date_id", F.lit(None).cast("int"))
    now = clean.timestamp_literal(a.LOAD_TS)
    filled = clean.column_defaults(rows, FACT_TRANSACTIONS, created_at=now, processed_at=now)
    return filled.select(
        "transaction_id", "date_id", "currency", "transaction_type", "created_at", "processed_at"
    )


@query
def proj_failure_rate(spark, sf):
    per_user = a.fact(spark, sf).groupBy("user_id").agg(
        F.count_if(F.col("status") == "failed").alias("failed_count"), F.count("*").alias("total_count")
    )
    return per_user.withColumn("failure_rate", fa.percentage(F.col("failed_count"), F.col("total_count")))


@query
def proj_coalesce_watermark(spark, sf):
    fact = a.fact(spark, sf)
    loaded = aggregates.coalesced_watermark(fact, "created_at")
    nothing = aggregates.coalesced_watermark(fact.where(F.col("status") == "refunded"), "created_at")
    return loaded.select(F.lit("loaded").alias("target"), "watermark").unionByName(
        nothing.select(F.lit("empty").alias("target"), "watermark")
    )


# Filters


@query
def flt_positive_amount(spark, sf):
    return filters.positive_amount(clean.parse_amount(a.raw_source(spark, sf))).select("transaction_id", "amount")


@query
def flt_valid_status(spark, sf):
    return filters.valid_status(clean.normalize_status(a.raw_source(spark, sf))).select("transaction_id", "status")


@query
def flt_server_errors(spark, sf):
    return filters.server_errors(a.logs(spark, sf, with_id=True)).select("event_id", "status_code")


@query
def flt_negative_amount(spark, sf):
    return filters.negative_amount(a.unchecked(spark, sf)).select("transaction_id", _dbl("amount"))


@query
def flt_invalid_status(spark, sf):
    return filters.invalid_status(a.unchecked(spark, sf)).select("transaction_id", "status")


@query
def flt_recent_failed(spark, sf):
    return filters.recent_failures(a.fact(spark, sf), a.AS_OF).select("transaction_id", "user_id", "created_at")


@query
def flt_having_count(spark, sf):
    return filters.having_more_than(a.fact(spark, sf), ["user_id", "status"], 3)


@query
def flt_current_dim(spark, sf):
    return filters.current_rows(a.dim_users(spark, sf)).select("user_id", "user_name", "user_category", "country")


@query
def flt_since_watermark(spark, sf):
    raw = a.cleaned(spark, sf).withColumn("processed_at", F.col("transaction_date"))
    loaded = raw.where(F.col("processed_at") < F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    return filters.since_watermark(raw, loaded).select("transaction_id", "processed_at")


# Joins


@query
def join_fact_dim_date(spark, sf):
    joined = joins.with_dates(a.fact(spark, sf), a.dim_date(spark))
    return joined.select("transaction_id", "full_date", "day_of_week", "month_name", "is_weekend")


@query
def join_users_failed(spark, sf):
    failures = aggregates.failures_per_user(a.fact(spark, sf), a.AS_OF)
    joined = joins.users_with_failures(a.dim_users(spark, sf), failures)
    return joined.select("user_id", "user_name", "user_category", "failed_count")


@query
def join_correlated_count(spark, sf):
    views = {"tw_fact": a.fact(spark, sf), "tw_users": a.dim_users(spark, sf)}
    return run_query(spark, joins.all_time_count_sql("{tw_fact}", "{tw_users}"), views=views)


@query
def join_anti_existing(spark, sf):
    days = lambda name, column: a.table(spark, sf, name).select(F.col(column).cast("date").alias("full_date"))
    new = joins.missing_keys(days("lineitem", "l_shipdate"), days("orders", "o_orderdate").distinct(), "full_date")
    return warehouse.date_dimension(new.where("full_date is not null"))


@query
def join_fk_orphans(spark, sf):
    known_users = filters.current_rows(a.dim_users(spark, sf))
    known_dates = a.dim_date(spark).where(F.col("full_date") <= F.lit(LAST_KNOWN_DATE))
    orphans = joins.fk_orphans(a.fact(spark, sf), known_users, known_dates)
    return orphans.select("transaction_id", "user_id", "date_id", "orphan_user", "orphan_date")


# Aggregations, sorts, series


@query
def agg_daily_summary(spark, sf):
    return aggregates.daily_summary(a.fact(spark, sf), a.dim_date(spark))


@query
def agg_error_summary(spark, sf):
    return _summary_columns(logs.summarize_errors(a.logs(spark, sf)))


@query
def agg_nunique_with_null(spark, sf):
    return aggregates.distinct_with_null(a.logs(spark, sf), ["endpoint"], "user_id")


@query
def agg_failed_per_user(spark, sf):
    return aggregates.failures_per_user(a.fact(spark, sf), a.AS_OF)


@query
def agg_global_count(spark, sf):
    return aggregates.row_count(a.unchecked(spark, sf))


@query
def agg_count_negative(spark, sf):
    return aggregates.negative_count(a.unchecked(spark, sf))


@query
def agg_invalid_status_counts(spark, sf):
    return aggregates.invalid_status_counts(a.unchecked(spark, sf))


@query
def agg_duplicate_keys(spark, sf):
    return aggregates.duplicate_keys(a.unchecked(spark, sf))


@query
def agg_null_counts(spark, sf):
    return aggregates.null_counts(a.unchecked(spark, sf), ["user_id", "amount", "transaction_date"])


@query
def agg_max_watermark(spark, sf):
    return aggregates.max_watermark(a.cleaned(spark, sf).withColumn("processed_at", F.col("transaction_date")))


@query
def sort_daily_summary(spark, sf):
    return sorting.by_day(aggregates.daily_summary(a.fact(spark, sf), a.dim_date(spark)))


@query
def sort_failed_users(spark, sf):
    return sorting.by_failures(aggregates.failures_per_user(a.fact(spark, sf), a.AS_OF))


@query
def gen_date_series(spark, sf):
    return warehouse.dates_spanning(a.table(spark, sf, "orders"), "o_orderdate")


# Data quality


@query
def dq_not_empty(spark, sf):
    return quality.check_not_empty(a.unchecked(spark, sf))


@query
def dq_no_negative(spark, sf):
    return quality.check_no_negative(a.unchecked(spark, sf))


@query
def dq_valid_status(spark, sf):
    return quality.check_valid_status(a.unchecked(spark, sf))


@query
def dq_no_duplicates(spark, sf):
    return quality.check_no_duplicates(a.unchecked(spark, sf))


@query
def dq_report(spark, sf):
    return quality.quality_report(a.unchecked(spark, sf))


@query
def dq_gate(spark, sf):
    """Failed checks of the table after its second batch, from the figures kept of both."""
    database = _database(spark)
    warehouse.create_star_schema(spark, database)
    raw, rows = f"{database}.raw_transactions", a.unchecked(spark, sf)
    for i in range(2):
        part = rows.where(F.pmod(F.col("transaction_id"), F.lit(2)) == i)
        tables.overwrite_batch(part.withColumn("batch_id", F.lit(f"b{i}")), raw, f"b{i}")
        report = verdicts.report(spark, raw)
    return quality.failed_checks(report)


@query
def dq_run_checks(spark, sf):
    return quality.run_check_rows(a.unchecked(spark, sf), CHECKS)


# Jobs


@query
def transform_transactions(spark, sf):
    return _raw_columns(a.cleaned(spark, sf))


@query
def validate_chunks(spark, sf):
    return _raw_columns(chunks.validate_chunks(a.chunked(spark, sf)))


@query
def quarantine_rows(spark, sf):
    rows = chunks.quarantine_rows(a.chunked(spark, sf))
    return rows.select("transaction_id", "chunk_id", "reason")


@query
def ingest_raw(spark, sf):
    database = _database(spark)
    warehouse.create_star_schema(spark, database)
    path, table = _csv_of_raw(spark, sf), f"{database}.raw_transactions"
    for _ in range(2):  # a repeated run changes nothing
        transactions.ingest_raw(
            spark, path, table, a.RUN_TS, ordinal="transaction_id", chunk_rows=a.CHUNK_ROWS,
            quarantine_table=f"{database}.quarantine",
        )
    return _raw_columns(spark.table(table))


@query
def load_fact_incremental(spark, sf):
    database = _database(spark)
    warehouse.create_star_schema(spark, database)
    raw, fact = f"{database}.raw_transactions", f"{database}.fact_transactions"
    rows = a.cleaned(spark, sf)
    late = F.coalesce(F.col("transaction_date") >= F.lit(SPLIT_DATE).cast("timestamp_ntz"), F.lit(False))
    users, days = a.dim_users(spark, sf), a.dim_date(spark)

    def load(part: DataFrame, run_ts: datetime, times: int) -> None:
        tables.overwrite_batch(clean.stamp_batch(part, run_ts), raw, clean.batch_name(run_ts))
        for _ in range(times):
            transactions.load_fact_incremental(
                spark, raw, fact, users, days, run_ts + timedelta(hours=1), on_violation="quarantine",
                quarantine_table=f"{database}.fact_quarantine",
            )

    load(rows.where(~late), a.RUN_TS, times=1)
    load(rows.where(late), a.RUN_TS + timedelta(hours=2), times=2)
    return _fact_columns(spark.table(fact))


@query
def fact_integrity(spark, sf):
    new = transactions.to_fact(a.unchecked(spark, sf), a.LOAD_TS)
    known_users = filters.current_rows(a.dim_users(spark, sf))
    known_dates = a.dim_date(spark).where(F.col("full_date") <= F.lit(LAST_KNOWN_DATE))
    loaded = a.fact(spark, sf).where(F.col("status") == "cancelled")
    flagged = integrity.violating(integrity.with_violations(new, known_users, known_dates, loaded))
    return flagged.select("transaction_id", F.concat_ws("; ", "violations").alias("violations"))


@query
def build_dim_date(spark, sf):
    database = _database(spark)
    warehouse.create_star_schema(spark, database)
    table = f"{database}.dim_date"
    orders, items = a.table(spark, sf, "orders"), a.table(spark, sf, "lineitem")
    warehouse.load_dim_date(spark, table, warehouse.dates_spanning(orders, "o_orderdate"))
    both = orders.select(F.col("o_orderdate").alias("d")).unionByName(items.select(F.col("l_shipdate").alias("d")))
    warehouse.load_dim_date(spark, table, warehouse.dates_spanning(both, "d"))
    return spark.table(table)


@query
def view_daily_summary(spark, sf):
    return warehouse.create_daily_view(spark, a.fact(spark, sf), a.dim_date(spark))


@query
def daily_summary_by_deltas(spark, sf):
    """Three loads of a fact, the later ones with late rows of all days, and an update after each."""
    database = _database(spark)
    warehouse.create_star_schema(spark, database)
    table, rows = f"{database}.fact_transactions", a.fact(spark, sf)
    part = F.crc32(F.col("transaction_id").cast("string").cast("binary")) % 3
    kept = daily.DailySummary(spark, table)
    for i in range(3):
        tables.append(rows.where(part == i), table, cluster_by="date_id", checked=True)
        kept.update()
    return kept.summary(a.dim_date(spark))


@query
def report_failed_users(spark, sf):
    return reports.failed_users(a.fact(spark, sf), a.dim_users(spark, sf), a.AS_OF)


@query
def clean_logs(spark, sf):
    return logs.clean_logs(a.logs(spark, sf, with_id=True)).select(
        "event_id", "timestamp", "endpoint", "endpoint_clean", "user_agent_clean", "status_code"
    )


@query
def error_log_summary(spark, sf):
    return _summary_columns(logs.error_log_summary(spark, _log_files(spark, sf), shared_dir(spark, "summary")))


@query
def error_log_rows(spark, sf):
    path = _log_files_with_bad_lines(spark, sf)
    return _error_row_columns(logs.error_log_rows(spark, path, shared_dir(spark, "rows")))


@query
def run_transactions(spark, sf):
    """Two runs an hour apart, each over half of the chunks."""
    database = _database(spark)
    warehouse.create_star_schema(spark, database)
    fact, path = f"{database}.fact_transactions", shared_dir(spark, "csv")
    users, days, rows = a.dim_users(spark, sf), a.dim_date(spark), a.raw_source(spark, sf)
    odd = chunks.chunk_of(F.col("transaction_id"), a.SMALL_CHUNK_ROWS) % 2
    for i in range(2):
        _write_csv(rows.where(odd == i), f"{path}/{i}")
        transactions.run_all(
            spark, f"{path}/{i}", f"{database}.raw_transactions", fact, users, days, a.RUN_TS + timedelta(hours=i),
            a.LOAD_TS + timedelta(hours=i), ordinal="transaction_id", chunk_rows=a.SMALL_CHUNK_ROWS,
        )
    return _fact_columns(spark.table(fact))


# Streams


@query
def stream_ingest_raw(spark, sf):
    database = _database(spark)
    warehouse.create_star_schema(spark, database)
    table, base = f"{database}.raw_transactions", shared_dir(spark, "arrivals")
    # One file per chunk, as the files are the units of acceptance.
    rows = a.chunked_source(spark, sf).repartition(F.col("chunk_id"))
    rows.write.partitionBy("chunk_id").options(
        header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(f"{base}/in")
    for _ in range(2):  # the second run finds no new files
        transaction_streams.ingest_new_files(
            spark, f"{base}/in/*", f"{base}/landing", f"{base}/checkpoint", table, a.RUN_TS
        )
    return _raw_columns(spark.table(table))


@query
def stream_error_summary(spark, sf):
    """Two runs; the second one's files hold rows of all hours, most of them late."""
    base = shared_dir(spark, "log-stream")
    rows = a.logs(spark, sf)
    late = F.coalesce(F.crc32(F.col("user_agent").cast("binary")) % 3 == 0, F.lit(False))
    for part in (rows.where(~late), rows.where(late)):
        part.write.mode("append").option("compression", "gzip").json(f"{base}/in")
        hours.merge_new_files(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _summary_columns(hours.HourlyErrors(spark, f"{base}/out").summary())


@query
def stream_dedup_transactions(spark, sf):
    base = shared_dir(spark, "redelivered")
    rows = a.raw_source(spark, sf)
    _write_csv(rows.unionByName(rows.where(F.col("status") == "Completed")), f"{base}/in")
    transaction_streams.dedup_files(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return transaction_streams.deduplicated(spark, f"{base}/out").select(
        "transaction_id", "user_id", _dbl("amount"), "transaction_date", "status"
    )
