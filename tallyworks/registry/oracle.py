"""SQL for DuckDB with the expected result of every registered query.

Each text is put together from named sub-queries and a final select. It states the expected result
in plain SQL on its own terms, not the way the Spark job gets there.
"""

from __future__ import annotations

from tallyworks.registry.adapters import (
    CHUNK_ROWS,
    DUCKDB_DIALECT,
    LOGS,
    RAW_SOURCE,
    SMALL_CHUNK_ROWS,
    USERS,
    in_dialect,
)

RUN = "timestamp '2024-02-01 06:00:00'"
LOAD = "timestamp '2024-02-01 07:00:00'"
BATCH = "'batch_20240201_060000'"
STATUSES = "('completed', 'failed', 'pending', 'cancelled')"
DATE_ID = "cast(strftime({0}, '%Y%m%d') as integer)"

# Sub-queries in the order they build on each other.
PARTS: dict[str, str] = {
    "raw_source": in_dialect(RAW_SOURCE, DUCKDB_DIALECT),
    "logs": in_dialect(LOGS, DUCKDB_DIALECT),
    "users": USERS,
    "typed": """
        select transaction_id, user_id, try_cast(nullif(amount, 'NaN') as double) as number, currency,
          try_cast(transaction_date as timestamp) as transaction_date, trim(lower(status)) as status
        from raw_source""",
    "cleaned": f"""
        select transaction_id, user_id, cast(number as decimal(15,2)) as amount, currency, transaction_date, status
        from typed where number > 0 and status in {STATUSES}""",
    "fact": f"""
        select transaction_id, user_id, {DATE_ID.format('transaction_date')} as date_id, amount, currency,
          status, transaction_date as created_at from cleaned""",
    "unchecked": """
        select transaction_id, user_id, cast(number as decimal(15,2)) as amount, transaction_date, status from typed
        union all
        select transaction_id, user_id, cast(number as decimal(15,2)), transaction_date, status from typed
        where status = 'completed'""",
    "bad_chunks": f"""
        select transaction_id // {CHUNK_ROWS} as chunk_id,
          count(*) filter (where user_id is null) as users,
          count(*) filter (where amount is null) as amounts,
          count(*) filter (where transaction_date is null) as dates
        from cleaned where user_id is null or amount is null or transaction_date is null group by all""",
    "failures": """
        select user_id, count(*) as failed_count from fact
        where status = 'failed' and created_at >= date '2024-01-31' - interval 7 day
        group by user_id having count(*) > 3""",
    "errors": """
        select *, strptime(ts_text, '%Y-%m-%d %H:%M:%S') as ts from logs where status_code >= 500""",
}

_NEEDS = {
    "typed": ["raw_source"],
    "cleaned": ["typed"],
    "fact": ["cleaned"],
    "unchecked": ["typed"],
    "bad_chunks": ["cleaned"],
    "failures": ["fact"],
    "errors": ["logs"],
}


def _with(names: str, select: str) -> str:
    """``select`` over the named sub-queries and everything those need."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{n} as ({PARTS[n]})" for n in wanted)
    return f"with {ctes}\n{select}" if ctes else select


def _date_parts(d: str) -> str:
    return (
        f"{DATE_ID.format(d)} as date_id, cast({d} as date) as full_date, cast(day({d}) as integer) as day, "
        f"cast(month({d}) as integer) as month, cast(year({d}) as integer) as year, "
        f"cast(quarter({d}) as integer) as quarter, cast(isodow({d}) as integer) as day_of_week, "
        f"rpad(dayname({d}), 9, ' ') as day_name, rpad(monthname({d}), 9, ' ') as month_name, "
        f"isodow({d}) in (6, 7) as is_weekend"
    )


RAW_OUT = (
    "transaction_id, user_id, cast(amount as double) as amount, currency, transaction_date, status, "
    f"{RUN} as processed_at, {BATCH} as batch_id"
)
SUMMARY = """
    select date_trunc('hour', ts) as hour, endpoint, count(*) as error_count,
      round(avg(response_time), 6) as avg_response_time, max(response_time) as max_response_time,
      min(response_time) as min_response_time,
      count(distinct coalesce(user_id, -1)) as unique_users
    from errors group by 1, 2"""
ERROR_ROWS = """
    select ts as timestamp, date_trunc('hour', ts) as hour, endpoint, status_code, response_time, user_agent, user_id
    from errors"""
LOG_ROWS = "select ts_text as timestamp, endpoint, status_code, response_time, user_agent, user_id from logs"
DAILY = """
    select cast(created_at as date) as transaction_date, status, count(*) as transaction_count,
      cast(sum(amount) as double) as total_amount, cast(sum(amount) as double) / count(amount) as average_amount,
      count(distinct user_id) as unique_users
    from fact where date_id is not null group by 1, 2"""
ACCEPTED = f"""
    select {RAW_OUT} from cleaned
    where transaction_id // {CHUNK_ROWS} not in (select chunk_id from bad_chunks)"""


def _check(name: str, figure: str, passed: str, error: str, details: str) -> str:
    """One check row from a sub-query with one figure ``n``."""
    return (
        f'select \'{name}\' as "check", {passed} as passed, case when not ({passed}) then {error} end as error, '
        f"{details} as details from ({figure})"
    )


CHECK_NOT_EMPTY = _check(
    "raw_transactions not empty", "select count(*) as n from unchecked", "n > 0",
    "'Table raw_transactions is empty'", "'Row count: ' || n",
)
CHECK_NEGATIVE = _check(
    "No negative amounts", "select count(*) as n from unchecked where amount < 0", "n = 0",
    "'Found ' || n || ' transactions with negative amounts'", "'Negative amount count: ' || n",
)
CHECK_STATUS = _check(
    "Valid statuses",
    "select count(*) as n, cast(coalesce(sum(c), 0) as bigint) as n_rows from (select status, count(*) as c from unchecked "
    f"where status not in {STATUSES} group by status)",
    "n = 0", "'Found invalid statuses: ' || n || ' different values in ' || n_rows || ' rows'", "'Invalid status count: ' || n",
)
CHECK_DUPLICATES = _check(
    "No duplicate transactions",
    "select count(*) as n from (select transaction_id from unchecked group by transaction_id having count(*) > 1)",
    "n = 0", "'Found ' || n || ' duplicate transactions'", "'Duplicate count: ' || n",
)
ALL_CHECKS = " union all ".join([CHECK_NOT_EMPTY, CHECK_NEGATIVE, CHECK_STATUS, CHECK_DUPLICATES])


def _spec_check(name: str, count: str, what: str = " rows violate the check") -> str:
    return _check(name, count, "n = 0", f"'{name}: ' || n || '{what}'", "'violations: ' || n")


SPEC_CHECKS = " union all ".join(
    [
        _check("not_empty", "select count(*) as n from unchecked", "n > 0", "'no rows'", "'rows: ' || n"),
        _spec_check("range(amount)", "select count(*) as n from unchecked where amount < 0 or amount > 100"),
        _spec_check("accepted_values(status)", f"select count(*) as n from unchecked where status not in {STATUSES}"),
        _spec_check("not_null(user_id)", "select count(*) as n from unchecked where user_id is null"),
        _spec_check(
            "unique(transaction_id)",
            "select count(*) as n from (select 1 from unchecked group by transaction_id having count(*) > 1)",
            " repeated keys",
        ),
    ]
)

ORACLE: dict[str, str] = {
    "src_csv_transactions": _with(
        "raw_source",
        "select cast(transaction_id as varchar) as transaction_id, cast(user_id as varchar) as user_id, "
        "nullif(amount, 'NaN') as amount, currency, transaction_date, status from raw_source",
    ),
    "src_jsonl_logs": _with("logs", LOG_ROWS),
    "src_jsonl_tolerant": _with("logs", LOG_ROWS),
    "src_sql_query": _with(
        "fact",
        "select user_id, count(*) as n_rows, cast(sum(amount) as double) as total from fact "
        "where status = 'completed' and created_at >= timestamp '2024-01-10' group by user_id",
    ),
    "sink_table_append": _with("cleaned", f"select {RAW_OUT} from cleaned"),
    "sink_parquet_summary": _with("errors", SUMMARY),
    "sink_parquet_chunks": _with(
        "errors",
        "select ts as timestamp, date_trunc('hour', ts) as hour, endpoint, status_code, response_time, user_agent, "
        f"user_id, event_id // {CHUNK_ROWS} as chunk_id from errors",
    ),
    "tbl_exists": _with(
        "cleaned",
        "select 'loaded' as table_name, true as table_exists, count(*) as row_count from cleaned "
        "union all select 'not_there', false, null",
    ),
    "tbl_create_from_df": _with("cleaned", f"select {RAW_OUT} from cleaned"),
    "ddl_star_schema": _with(
        "fact users",
        "select 'dim_date' as table_name, 10 as n_columns, datediff('day', min(ts), max(ts)) + 1 as row_count, "
        "datediff('day', min(ts), max(ts)) + 1 as filled from events "
        "union all select 'dim_users', 10, count(*), count(*) from users "
        "union all select 'fact_transactions', 9, count(*), count(*) from fact where user_id is not null and date_id is not null "
        "union all select 'raw_transactions', 9, count(*), 0 from cleaned",
    ),
    "proj_parse_dates": _with("typed", "select transaction_id, transaction_date from typed"),
    "proj_parse_amount": _with("typed", "select transaction_id, number as amount from typed"),
    "proj_normalize_status": _with("typed", "select transaction_id, status from typed"),
    "proj_batch_stamp": _with(
        "raw_source", f"select transaction_id, {RUN} as processed_at, {BATCH} as batch_id from raw_source"
    ),
    "proj_log_timestamp": "select event_id, date_trunc('second', ts) as ts from events",
    "proj_log_timestamp_infer": "select event_id, date_trunc('second', ts) as ts from events",
    "proj_endpoint_path": _with(
        "logs",
        "select event_id, nullif(regexp_extract(endpoint, '(/[a-zA-Z0-9_\\-./]+)', 1), '') as endpoint_clean from logs",
    ),
    "proj_user_agent": _with("logs", "select event_id, left(user_agent, 100) as user_agent_clean from logs"),
    "proj_hour_trunc": "select event_id, date_trunc('hour', ts) as hour from events",
    "proj_date_key": f"select o_orderkey, {DATE_ID.format('o_orderdate')} as date_id from orders",
    "proj_date_parts": f"select o_orderkey, {_date_parts('o_orderdate')} from orders",
    "proj_weekend_flag": "select o_orderkey, isodow(o_orderdate) in (6, 7) as is_weekend from orders",
    "proj_column_defaults": _with(
        "cleaned",
        "select transaction_id, cast(null as integer) as date_id, 'USD' as currency, "
        f"cast(null as varchar) as transaction_type, {LOAD} as created_at, {LOAD} as processed_at from cleaned",
    ),
    "proj_failure_rate": _with(
        "fact",
        "select user_id, count(*) filter (where status = 'failed') as failed_count, count(*) as total_count, "
        "cast(count(*) filter (where status = 'failed') as double) * 100.0 / count(*) as failure_rate "
        "from fact group by user_id",
    ),
    "proj_coalesce_watermark": _with(
        "fact",
        "select 'loaded' as target, max(created_at) as watermark from fact "
        "union all select 'empty', timestamp '1900-01-01'",
    ),
    "flt_positive_amount": _with("typed", "select transaction_id, number as amount from typed where number > 0"),
    "flt_valid_status": _with("typed", f"select transaction_id, status from typed where status in {STATUSES}"),
    "flt_server_errors": _with("logs", "select event_id, status_code from logs where status_code >= 500"),
    "flt_negative_amount": _with(
        "unchecked", "select transaction_id, cast(amount as double) as amount from unchecked where amount < 0"
    ),
    "flt_invalid_status": _with(
        "unchecked", f"select transaction_id, status from unchecked where status not in {STATUSES}"
    ),
    "flt_recent_failed": _with(
        "fact",
        "select transaction_id, user_id, created_at from fact "
        "where status = 'failed' and created_at >= date '2024-01-31' - interval 7 day",
    ),
    "flt_having_count": _with(
        "fact", "select user_id, status, count(*) as n from fact group by user_id, status having count(*) > 3"
    ),
    "flt_current_dim": _with("users", "select user_id, user_name, user_category, country from users where is_current"),
    "flt_since_watermark": _with(
        "cleaned",
        "select transaction_id, transaction_date as processed_at from cleaned where transaction_date >= "
        "(select coalesce(max(transaction_date), timestamp '1900-01-01') from cleaned "
        "where transaction_date < timestamp '2024-01-16')",
    ),
    "join_fact_dim_date": _with(
        "fact",
        "select transaction_id, cast(created_at as date) as full_date, cast(isodow(created_at) as integer) as day_of_week, "
        "rpad(monthname(created_at), 9, ' ') as month_name, isodow(created_at) in (6, 7) as is_weekend "
        "from fact where created_at between timestamp '2023-01-01' and timestamp '2027-12-31 23:59:59.999999'",
    ),
    "join_users_failed": _with(
        "failures users",
        "select u.user_id, user_name, user_category, failed_count from users u join failures f on u.user_id = f.user_id",
    ),
    "join_correlated_count": _with(
        "fact users",
        "select u.user_id, coalesce(c.n, 0) as total_count from users u "
        "left join (select user_id, count(*) as n from fact group by user_id) c on u.user_id = c.user_id "
        "where u.is_current",
    ),
    "join_anti_existing": (
        f"select {_date_parts('d')} from (select distinct cast(l_shipdate as date) as d from lineitem) "
        "where d not in (select cast(o_orderdate as date) from orders)"
    ),
    "join_fk_orphans": _with(
        "fact users",
        "select * from (select transaction_id, user_id, date_id, "
        "user_id is not null and user_id not in (select user_id from users where is_current) as orphan_user, "
        "date_id is not null and date_id not between 20230101 and 20240120 as orphan_date from fact) "
        "where orphan_user or orphan_date",
    ),
    "agg_daily_summary": _with("fact", DAILY),
    "agg_error_summary": _with("errors", SUMMARY),
    "agg_nunique_with_null": _with(
        "logs", "select endpoint, count(distinct coalesce(user_id, -1)) as n_unique from logs group by endpoint"
    ),
    "agg_failed_per_user": _with("failures", "select user_id, failed_count from failures"),
    "agg_global_count": _with("unchecked", "select count(*) as row_count from unchecked"),
    "agg_count_negative": _with("unchecked", "select count(*) as negative_count from unchecked where amount < 0"),
    "agg_invalid_status_counts": _with(
        "unchecked", f'select status, count(*) as "count" from unchecked where status not in {STATUSES} group by status'
    ),
    "agg_duplicate_keys": _with(
        "unchecked",
        'select transaction_id, count(*) as "count" from unchecked group by transaction_id having count(*) > 1',
    ),
    "agg_null_counts": _with(
        "unchecked",
        "select count(*) - count(user_id) as user_id_nulls, count(*) - count(amount) as amount_nulls, "
        "count(*) - count(transaction_date) as transaction_date_nulls from unchecked",
    ),
    "agg_max_watermark": _with("cleaned", "select max(transaction_date) as max_processed_at from cleaned"),
    "sort_daily_summary": _with("fact", DAILY + " order by transaction_date desc, status"),
    "sort_failed_users": _with(
        "failures", "select user_id, failed_count from failures order by failed_count desc, user_id"
    ),
    "gen_date_series": (
        "select cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), "
        "interval 1 day)) as date) as full_date from orders"
    ),
    "dq_not_empty": _with("unchecked", CHECK_NOT_EMPTY),
    "dq_no_negative": _with("unchecked", CHECK_NEGATIVE),
    "dq_valid_status": _with("unchecked", CHECK_STATUS),
    "dq_no_duplicates": _with("unchecked", CHECK_DUPLICATES),
    "dq_report": _with("unchecked", f"select *, bool_and(passed) over () as is_valid from ({ALL_CHECKS})"),
    "dq_gate": _with("unchecked", f"select * from ({ALL_CHECKS}) where not passed"),
    "dq_run_checks": _with("unchecked", SPEC_CHECKS),
    "transform_transactions": _with("cleaned", f"select {RAW_OUT} from cleaned"),
    "validate_chunks": _with("bad_chunks", ACCEPTED),
    "quarantine_rows": _with(
        "bad_chunks",
        "select c.transaction_id, b.chunk_id, 'null values in ' || concat_ws(', ', "
        "case when users > 0 then 'user_id: ' || users end, case when amounts > 0 then 'amount: ' || amounts end, "
        "case when dates > 0 then 'transaction_date: ' || dates end) as reason "
        f"from cleaned c join bad_chunks b on c.transaction_id // {CHUNK_ROWS} = b.chunk_id",
    ),
    "ingest_raw": _with("bad_chunks", ACCEPTED),
    "load_fact_incremental": _with(
        "fact",
        "select transaction_id, user_id, date_id, cast(amount as double) as amount, currency, status, "
        f"case when created_at >= timestamp '2024-01-16' then {RUN} + interval 3 hour else {LOAD} end as processed_at "
        "from fact where user_id is not null and date_id is not null",
    ),
    "fact_integrity": _with(
        "unchecked cleaned users",
        "select * from (select transaction_id, concat_ws('; ', "
        "case when user_id is null then 'user_id is null' end, "
        "case when transaction_date is null then 'date_id is null' end, "
        "case when amount is null then 'amount is null' end, "
        "case when count(*) over (partition by transaction_id) > 1 then 'duplicate transaction_id' end, "
        "case when transaction_id in (select transaction_id from cleaned where status = 'cancelled') "
        "then 'transaction_id already loaded' end, "
        "case when user_id not in (select user_id from users where is_current) then 'unknown user_id' end, "
        "case when cast(transaction_date as date) not between date '2023-01-01' and date '2024-01-20' "
        "then 'unknown date_id' end) as violations from unchecked) where violations <> ''",
    ),
    "build_dim_date": (
        f"select {_date_parts('d')} from (select cast(unnest(generate_series(min(t), max(t), interval 1 day)) as date) as d "
        "from (select cast(o_orderdate as date) as t from orders union all select cast(l_shipdate as date) from lineitem))"
    ),
    "view_daily_summary": _with("fact", DAILY),
    "daily_summary_by_deltas": _with("fact", DAILY),
    "report_failed_users": _with(
        "failures users",
        "select u.user_id, u.user_name, u.user_category, f.failed_count, "
        "cast(f.failed_count as double) * 100.0 / t.n as failure_rate "
        "from failures f join users u on u.user_id = f.user_id "
        "join (select user_id, count(*) as n from fact group by user_id) t on t.user_id = f.user_id "
        "where u.is_current",
    ),
    "clean_logs": _with(
        "logs",
        "select event_id, strptime(ts_text, '%Y-%m-%d %H:%M:%S') as timestamp, endpoint, "
        "nullif(regexp_extract(endpoint, '(/[a-zA-Z0-9_\\-./]+)', 1), '') as endpoint_clean, "
        "left(user_agent, 100) as user_agent_clean, status_code from logs",
    ),
    "error_log_summary": _with("errors", SUMMARY),
    "error_log_rows": _with("errors", ERROR_ROWS),
    "run_transactions": _with(
        "fact",
        "select transaction_id, user_id, date_id, cast(amount as double) as amount, currency, status, "
        f"case when transaction_id // {SMALL_CHUNK_ROWS} % 2 = 1 then {LOAD} + interval 1 hour else {LOAD} end as processed_at "
        "from fact f where not exists (select 1 from fact b "
        f"where b.transaction_id // {SMALL_CHUNK_ROWS} = f.transaction_id // {SMALL_CHUNK_ROWS} "
        "and (b.user_id is null or b.created_at is null))",
    ),
    "stream_ingest_raw": _with("bad_chunks", ACCEPTED),
    "stream_error_summary": _with("errors", SUMMARY),
    "stream_dedup_transactions": _with(
        "typed",
        "select transaction_id, user_id, cast(cast(number as decimal(15,2)) as double) as amount, transaction_date, status "
        "from typed where transaction_date is not null",
    ),
}
