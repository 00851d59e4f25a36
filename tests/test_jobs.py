"""Jobs: ingest, load, whole run, tables and log files."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyworks.operators import aggregates, integrity, quality
from tallyworks.plans import logs, reports, transactions, warehouse
from tallyworks.sinks import files, tables
from tallyworks.sources import logs_json, transactions_csv
from tallyworks.sources.tables import run_query, table_exists

RUN = datetime(2024, 2, 1, 6)
HEADER = "transaction_id,user_id,amount,currency,transaction_date,status"


def _users(spark, *ids):
    return spark.createDataFrame([(i, f"u{i}", "A", True) for i in ids], "user_id bigint, user_name string, user_category string, is_current boolean")


def test_ingest_keeps_good_files_and_quarantines_others(spark, folder, lines, database):
    lines(folder, [HEADER, "1,7,10.50,USD,2024-01-01 10:00:00, Completed ", "2,7,-1,USD,2024-01-01,failed", "3,8,1e2,EUR,2024-01-02,odd"])
    lines(folder, [HEADER, "4,NA,5,USD,2024-01-03,failed", "5,8,6,USD,2024-01-03,pending"])
    raw, held = f"{database}.raw_transactions", f"{database}.held"
    for _ in range(2):
        counts = transactions.ingest_raw(spark, folder, raw, RUN, quarantine_table=held)
        assert counts == {"rows_read": 5, "surplus_lines": 0, "accepted": 1, "quarantined": 2, "rejected_chunks": 1}
        assert [r.transaction_id for r in spark.table(raw).collect()] == [1]
        assert sorted(r.transaction_id for r in spark.table(held).collect()) == [4, 5]
    transactions.ingest_raw(spark, folder, raw, RUN + timedelta(hours=1), unit="row")
    assert sorted(r.transaction_id for r in spark.table(raw).collect()) == [1, 1, 5]
    assert spark.table(raw).where("batch_id = 'batch_20240201_060000'").count() == 1


def test_lines_with_surplus_fields_are_kept_apart(spark, folder, lines, database):
    lines(folder, [HEADER, "1,7,10.50,USD,2024-01-01,failed,EXTRA,MORE", "2,7,1,000.50,USD,2024-01-01,failed", "3,7,5,USD,2024-01-01,failed", "4,7,5,USD,2024-01-01,failed,"])
    lines(folder, [HEADER, "5,7,5,USD,2024-01-01", '6,7,"1,5",USD,2024-01-01,failed', '7,7,5,USD,2024-01-01,"failed"'])
    raw = f"{database}.raw_transactions"
    counts = transactions.ingest_raw(spark, folder, raw, RUN)
    assert (counts["rows_read"], counts["surplus_lines"], counts["accepted"], counts["quarantined"]) == (7, 3, 2, 3)
    held = spark.table(f"{raw}_quarantine").collect()
    assert {r.reason for r in held} == {"more fields than columns"} and {r.line.split(",")[0] for r in held} == {"1", "2", "4"}
    assert sorted(r.transaction_id for r in spark.table(raw).collect()) == [3, 7]
    assert sorted(r.transaction_id for r in transactions_csv.read_transactions(spark, folder).collect()) == ["3", "5", "6", "7"]


def test_quoted_line_breaks_if_asked(spark, folder, lines):
    lines(folder, [HEADER, '1,7,5,USD,2024-01-01,"fai', 'led"', "2,7,5,USD,2024-01-01,failed"])
    assert transactions_csv.read_transactions(spark, folder, multi_line=True).count() == 2


def test_batches_written_at_once_both_stay(spark, database):
    raw = f"{database}.raw_transactions"
    rows = lambda b: spark.range(50).selectExpr("id as transaction_id", f"'{b}' as batch_id")
    names = [f"b{i}" for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        for _ in range(2):
            assert list(pool.map(lambda b: tables.overwrite_batch(rows(b), raw, b), names)) == [50] * 4
    assert {r.batch_id: r["count"] for r in spark.table(raw).groupBy("batch_id").count().collect()} == dict.fromkeys(names, 50)
    with pytest.raises(Exception, match="does not belong"):
        tables.overwrite_batch(rows("b1"), raw, "b2")
    assert spark.table(raw).count() == 200


def test_a_repeated_run_without_rows_removes_its_batch(spark, database):
    raw = f"{database}.raw_transactions"
    rows = spark.sql("""select 1L as transaction_id, "it's" as batch_id union all select 2L, "it's\"""")
    assert tables.overwrite_batch(rows, raw, "it's") == 2
    tables.append(spark.sql("select 3L as transaction_id, 'other' as batch_id"), raw)
    assert tables.overwrite_batch(rows.where("transaction_id > 5"), raw, "it's") == 0
    assert [r.transaction_id for r in spark.table(raw).collect()] == [3]


def test_columns_come_from_the_header_if_asked(spark, folder, lines, database):
    lines(folder, ["status,amount,user_id", "failed,3,1"])
    rows = transactions_csv.read_transactions(spark, folder, schema=None)
    assert rows.columns == ["status", "amount", "user_id", "chunk_id"]
    raw = f"{database}.raw_transactions"
    transactions.ingest_raw(spark, folder, raw, RUN, schema=None)
    assert spark.table(raw).count() == 0


def test_header_that_differs_from_the_schema_is_an_error(spark, folder, lines):
    lines(folder, ["user_id,transaction_id,amount,currency,transaction_date,status", "1,2,3,USD,2024-01-01,failed"])
    with pytest.raises(Exception, match="(?i)header"):
        transactions_csv.read_transactions(spark, folder).collect()


def test_append_is_by_name(spark, database):
    raw = f"{database}.raw_transactions"
    tables.append(spark.sql("select 'b' as batch_id, 5L as transaction_id"), raw)
    row = spark.table(raw).first()
    assert (row.transaction_id, row.user_id, row.batch_id) == (5, None, "b")
    with pytest.raises(ValueError, match="extra"):
        tables.append(spark.sql("select 1 as extra"), raw)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        tables.append(spark.sql("select 'b' as batch_id, 'USDX' as currency"), raw)


def test_defaults_of_the_tables(spark, database):
    tables.append(spark.sql("select 1L as user_id, date'2024-01-01' as valid_from"), f"{database}.dim_users")
    row = spark.table(f"{database}.dim_users").first()
    assert (row.valid_to, row.is_current) == (date(9999, 12, 31), True)
    assert row.created_at is not None and row.updated_at is not None
    tables.append(spark.sql("select 2L as user_id, date'2024-01-01' as valid_from, cast(null as boolean) as is_current"), f"{database}.dim_users")
    assert spark.table(f"{database}.dim_users").where("user_id = 2").first().is_current is None


def test_create_table_from_frame(spark, database):
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert not table_exists(spark, f"{database}.made")
    tables.create_from_df(rows, f"{database}.made", primary_key="k")
    with pytest.raises(integrity.IntegrityError, match="not a key"):
        tables.append(rows, f"{database}.made")
    assert tables.append(rows.limit(1), f"{database}.made") == 1
    with pytest.raises(integrity.IntegrityError, match="exists"):
        tables.append(rows.limit(1), f"{database}.made")
    with pytest.raises(integrity.IntegrityError, match="NULL"):
        tables.append(rows.selectExpr("cast(null as int) as k", "v").limit(1), f"{database}.made")
    spark.sql(f"TRUNCATE TABLE {database}.made")
    assert table_exists(spark, f"{database}.made")
    assert spark.table(f"{database}.made").count() == 0
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.create_from_df(rows, f"{database}.made")


def test_save_modes(spark, database):
    rows, name = spark.range(3), f"{database}.saved"
    tables.save(rows, name)
    tables.save(rows, name)
    assert spark.table(name).count() == 6
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.save(rows, name, "fail")
    tables.save(rows, name, "replace")
    assert spark.table(name).count() == 3


def test_date_dimension_inserts_only_what_is_missing(spark, database):
    table = f"{database}.dim_date"
    warehouse.load_dim_date(spark, table, warehouse.date_series(spark, date(2023, 1, 5), 3))
    warehouse.load_dim_date(spark, table)
    warehouse.load_dim_date(spark, table)
    assert spark.table(table).count() == 1826
    assert spark.table(table).select("date_id").distinct().count() == 1826


def _raw(spark, rows, run_ts, table):
    frame = spark.createDataFrame(rows, "transaction_id bigint, user_id bigint, amount double, transaction_date string, status string")
    from tallyworks.operators import clean

    tables.overwrite_batch(clean.transform_transactions(frame, run_ts), table, clean.batch_name(run_ts))


def test_incremental_load(spark, database):
    raw, fact = f"{database}.raw_transactions", f"{database}.fact_transactions"
    users, days = _users(spark, 1, 2), warehouse.default_date_dimension(spark)
    load = lambda at, **o: transactions.load_fact_incremental(spark, raw, fact, users, days, at, **o)
    _raw(spark, [(1, 1, 5.0, "2024-01-01", "failed"), (2, 2, 6.0, "2024-01-02", "pending")], RUN, raw)
    load(RUN + timedelta(minutes=10))
    assert spark.table(fact).count() == 2
    load(RUN + timedelta(minutes=20))
    assert spark.table(fact).count() == 2
    # A batch stamped later with a repeated id, an unknown user and a date outside the dimension.
    later = RUN + timedelta(hours=1)
    _raw(spark, [(2, 1, 1.0, "2024-01-03", "failed"), (3, 9, 1.0, "2024-01-03", "failed"),
                 (4, 1, 1.0, "1999-01-03", "failed"), (5, 1, 1.0, "2024-01-03", "failed")], later, raw)
    with pytest.raises(integrity.IntegrityError, match="already loaded"):
        load(later)
    assert spark.table(fact).count() == 2
    held = f"{database}.held"
    for _ in range(3):  # nothing is pending after the first
        load(later, on_violation="quarantine", quarantine_table=held)
        assert sorted(r.transaction_id for r in spark.table(fact).collect()) == [1, 2, 5]
        assert sorted(r.transaction_id for r in spark.table(held).collect()) == [2, 3, 4]
    # A batch with an id of its own, stamped before the last load but stored after it.
    early = spark.createDataFrame([(8, 1, 5.0, "2024-01-01", "failed")], "transaction_id bigint, user_id bigint, amount double, transaction_date string, status string")
    from tallyworks.operators import clean

    tables.overwrite_batch(clean.transform_transactions(early, RUN - timedelta(days=1), "a-run"), raw, "a-run")
    assert load(later, choose="watermark") == 0
    with pytest.raises(ValueError, match="mode"):
        load(later, on_violation="ignore")


def test_late_batches_and_cut_off_loads_are_made_up_for(spark, database):
    raw, fact = f"{database}.raw_transactions", f"{database}.fact_transactions"
    users, days = _users(spark, 1), warehouse.default_date_dimension(spark)
    load = lambda at, **o: transactions.load_fact_incremental(spark, raw, fact, users, days, at, **o)
    _raw(spark, [(1, 1, 5.0, "2024-01-01", "failed"), (2, 1, 6.0, "2024-01-02", "failed")], RUN, raw)
    assert load(RUN) == 2
    _raw(spark, [(3, 1, 5.0, "2024-01-01", "failed")], RUN - timedelta(hours=5), raw)
    assert load(RUN) == 1
    # A load that stopped after it had stored one of two rows.
    later = RUN + timedelta(hours=1)
    _raw(spark, [(4, 1, 5.0, "2024-01-01", "failed"), (5, 1, 6.0, "2024-01-02", "failed")], later, raw)
    name = "batch_20240201_070000"
    transactions._note(transactions._batch_records(spark, fact), [name], transactions.STARTED, later)
    transactions._id_ledger(spark, fact).add(spark.sql(f"select explode(array(4L, 5L)) as key, '{name}' as batch_id, 1L as n"))
    tables.append(spark.sql("select 4L as transaction_id, 1L as user_id, 20240101 as date_id, 5.0 as amount, 'failed' as status, timestamp_ntz'2024-02-01 07:00:00' as processed_at"), fact)
    assert load(later) == 1
    assert sorted(r.transaction_id for r in spark.table(fact).collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError, match="later than the run"):
        _raw(spark, [(6, 1, 5.0, "2024-01-01", "failed")], later + timedelta(hours=1), raw)
        load(later + timedelta(hours=1), choose="watermark")


def test_loads_that_start_together_load_each_row_once(spark, database):
    raw, fact = f"{database}.raw_transactions", f"{database}.fact_transactions"
    users, days = _users(spark, 1), warehouse.default_date_dimension(spark)
    _raw(spark, [(i, 1, 5.0, "2024-01-01", "failed") for i in range(20)], RUN, raw)
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda i: transactions.load_fact_incremental(spark, raw, fact, users, days, RUN + timedelta(hours=i)), range(2)))
    assert sorted(done) == [0, 20] and spark.table(fact).count() == 20
    # two batches with ids in common, loaded at once: the second load finds the first one's ids
    _raw(spark, [(50, 1, 5.0, "2024-01-01", "failed")], RUN + timedelta(hours=3), raw)
    assert transactions.load_fact_incremental(spark, raw, fact, users, days, RUN + timedelta(hours=3)) == 1
    _raw(spark, [(50, 1, 5.0, "2024-01-01", "failed")], RUN + timedelta(hours=4), raw)
    with pytest.raises(integrity.IntegrityError, match="already loaded"):
        transactions.load_fact_incremental(spark, raw, fact, users, days, RUN + timedelta(hours=4))


def test_a_load_that_lost_its_claim_stores_nothing(spark, database, monkeypatch):
    raw, fact = f"{database}.raw_transactions", f"{database}.fact_transactions"
    _raw(spark, [(1, 1, 5.0, "2024-01-01", "failed")], RUN, raw)
    taken = transactions.integrity.passing

    def slow(flagged):
        from tallyworks.sinks import claims

        folder = claims.Folder(spark, f"{transactions.location(spark, fact)}_load_claims")
        folder.create(f"claim-{claims._latest(folder) + 1}", 0)
        return taken(flagged)

    monkeypatch.setattr(transactions.integrity, "passing", slow)
    with pytest.raises(transactions.claims.ClaimedError):
        transactions.load_fact_incremental(spark, raw, fact, _users(spark, 1), warehouse.default_date_dimension(spark), RUN)
    assert spark.table(fact).count() == 0


def test_records_of_batches_are_gathered(spark, folder, monkeypatch):
    from tallyworks.sinks.claims import Folder

    monkeypatch.setattr(transactions, "LOOSE_RECORDS", 6)
    records = Folder(spark, folder)
    for i in range(9):
        transactions._note(records, [f"b/{i}"], transactions.STARTED, RUN)
        if i % 3:
            transactions._note(records, [f"b/{i}"], transactions.LOADED, RUN, i)
        assert transactions._batch_states(records) == ({f"b/{k}" for k in range(0, i + 1, 3)}, {f"b/{k}" for k in range(i + 1) if k % 3})
    assert len(records.names()) <= 7


def test_hourly_runs_with_the_defaults(spark, folder, lines, database):
    raw, fact = f"{database}.raw_transactions", f"{database}.fact_transactions"
    users, days = _users(spark, 1), warehouse.default_date_dimension(spark)
    for i in range(3):
        lines(f"{folder}/{i}", [HEADER, f"{i},1,10,USD,2024-01-01,failed"])
        assert transactions.run_all(spark, f"{folder}/{i}", raw, fact, users, days, RUN + timedelta(hours=i)) == 1
    assert spark.table(fact).count() == 3


def test_gate_stops_the_load(spark, folder, lines, database):
    lines(folder, [HEADER, "1,1,10,USD,2024-01-01,failed", "1,1,10,USD,2024-01-01,failed"])
    raw, fact = f"{database}.raw_transactions", f"{database}.fact_transactions"
    args = (spark, folder, raw, fact, _users(spark, 1), warehouse.default_date_dimension(spark), RUN)
    with pytest.raises(quality.DataQualityError):
        transactions.run_all(*args)
    assert spark.table(fact).count() == 0


def test_whole_run(spark, folder, lines, database):
    lines(folder, [HEADER] + [f"{i},1,10,USD,2024-01-0{i},failed" for i in range(1, 6)] + ["6,1,10,USD,2024-01-07,completed"])
    raw, fact = f"{database}.raw_transactions", f"{database}.fact_transactions"
    users, days = _users(spark, 1, 2), warehouse.default_date_dimension(spark)
    transactions.run_all(spark, folder, raw, fact, users, days, RUN, created_at_source="event")
    report = reports.failed_users(spark.table(fact), users, date(2024, 1, 8), more_than=4).collect()
    assert [(r.user_id, r.failed_count, r.failure_rate) for r in report] == [(1, 5, 500.0 / 6)]
    assert reports.failed_users(spark.table(fact), users, date(2024, 1, 9), more_than=4).count() == 0
    summary = reports.daily_summary(spark.table(fact), days).collect()
    assert [r.transaction_date for r in summary] == [date(2024, 1, d) for d in (7, 5, 4, 3, 2, 1)]


def test_view(spark):
    days = warehouse.default_date_dimension(spark)
    fact = spark.sql("select 20240101 as date_id, 'failed' as status, 1.50BD as amount, 1L as user_id")
    warehouse.create_daily_view(spark, fact, days, "tw_daily")
    row = run_query(spark, "select * from tw_daily where status = :s", {"s": "failed"}).first()
    assert (row.transaction_count, row.total_amount, row.unique_users) == (1, 1.5, 1)


GOOD = '{"timestamp":"2024-01-01 10:20:30","endpoint":"/a","status_code":500,"response_time":1.5,"user_agent":"x","user_id":3}'


def test_tolerant_scan_sorts_lines_out(spark, folder, lines):
    odd = [
        GOOD[:-1], "bad line", "5", "null", '{"status_code":"x"}', GOOD + " trailing", GOOD + GOOD, GOOD + "," + GOOD, "[" + GOOD + "]",
    ]
    fine = [
        GOOD, "  " + GOOD + "  ", '{"status_code":503,"endpoint":"/}","extra":{"a":[1]}}', "{}",
    ]
    lines(folder, fine + odd + ["", "   "], compression="gzip")
    good, bad = logs_json.split_lines(spark, folder)
    assert good.count() == len(fine)
    assert sorted(r.value for r in bad.collect()) == sorted(odd)
    assert {r.endpoint for r in good.collect()} == {"/a", "/}", None}
    # The number of good rows must not depend on the columns a query happens to use.
    assert good.select("endpoint").collect().__len__() == len(fine)


def test_error_rows_keep_bad_lines_apart(spark, folder, lines):
    lines(f"{folder}/in", [GOOD, "bad line", GOOD.replace("500", "404")])
    rows = logs.error_log_rows(spark, f"{folder}/in", f"{folder}/out", bad_lines_path=f"{folder}/bad")
    assert [(r.hour, r.endpoint) for r in rows.collect()] == [(datetime(2024, 1, 1, 10), "/a")]
    assert [r.value for r in spark.read.parquet(f"{folder}/bad").collect()] == ["bad line"]


def test_strict_scan_stops(spark, folder, lines):
    lines(folder, [GOOD, "bad line"])
    with pytest.raises(Exception, match="(?i)malformed"):
        logs_json.read_logs(spark, folder).collect()
    seen = Observation()
    assert logs_json.read_logs_tolerant(spark, folder, seen=seen).count() == 1 and seen.get == {"lines": 2, "bad": 1}


def test_error_summary_keys_and_nulls(spark, folder):
    rows = spark.createDataFrame(
        [
            ("2024-01-01 10:20:30", "/a?x=1", 500, 1.0, "x", 1),
            ("2024-01-01 10:59:59", "/a?x=2", 503, 3.0, "x", None),
            ("2024-01-01 11:00:00", None, 599, None, "x", None),
            ("not checked, as it is no error", "/a", 499, 1.0, "x", 1),
        ],
        "timestamp string, endpoint string, status_code int, response_time double, user_agent string, user_id bigint",
    )
    by_raw = logs.summarize_errors(rows)
    assert by_raw.count() == 3
    by_path = {(r.hour, r.endpoint): r for r in logs.summarize_errors(rows, "endpoint_clean").collect()}
    a = by_path[datetime(2024, 1, 1, 10), "/a"]
    assert (a.error_count, a.avg_response_time, a.max_response_time, a.min_response_time, a.unique_users) == (2, 2.0, 3.0, 1.0, 2)
    none = by_path[datetime(2024, 1, 1, 11), None]
    assert (none.error_count, none.avg_response_time, none.unique_users) == (1, None, 1)
    files.write_summary(by_raw, folder, "hour")
    assert spark.read.parquet(folder).where("day = date'2024-01-01'").count() == 3


def test_chunk_files(spark, folder):
    rows = spark.range(25).withColumn("chunk_id", F.floor(F.col("id") / 10)).where("id < 10 or id >= 20").coalesce(1)
    files.write_chunks(rows, folder, "chunk_id")
    back = spark.read.parquet(folder)
    assert {r.chunk_id for r in back.select("chunk_id").distinct().collect()} == {0, 2}
    assert not [f for f in back.inputFiles() if "chunk_id=" in f]
    files.write_chunks(rows, folder + "-rows", rows_per_file=4)
    assert len(spark.read.parquet(folder + "-rows").inputFiles()) == 4


def test_watermark_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "processed_at timestamp_ntz")
    assert aggregates.coalesced_watermark(empty).first()[0] == datetime(1900, 1, 1)
