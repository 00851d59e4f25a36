"""Streams: same result as in batch, restarts, late data, re-delivered rows."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import logs
from tallyworks.registry import adapters
from tallyworks.session import remove, subfolders
from tallyworks.sinks import periods
from tallyworks.sources import logs_json
from tallyworks.streaming import hours
from tallyworks.streaming import logs as log_streams
from tallyworks.streaming import transactions as transaction_streams
from tests.conftest import SMALL

HEADER = "transaction_id,user_id,amount,currency,transaction_date,status"


def _line(at, user=1, status=500, time=1.0, endpoint="/a"):
    return json.dumps({"timestamp": at, "endpoint": endpoint, "status_code": status, "response_time": time, "user_id": user})


def _summarize(spark, folder, **options):
    log_streams.summarize_new_files(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", **options).awaitTermination()
    return spark.read.schema(
        "endpoint string, error_count bigint, avg_response_time double, max_response_time double, "
        "min_response_time double, unique_users bigint, hour timestamp_ntz"
    ).parquet(f"{folder}/out")


def test_hours_appear_once_complete_and_late_rows_stay_out(spark, folder, lines):
    lines(f"{folder}/in", [
        _line("2024-01-01 10:05:00", 1), _line("2024-01-01 10:10:00", None), _line("2024-01-01 10:15:00", None, time=None),
        _line("2024-01-01 10:20:00", 1, time=4.0), "bad line", _line("2024-01-01 10:30:00", 1, status=404),
    ])
    assert _summarize(spark, folder, delay="30 minutes").count() == 0
    # A line that is no error tells the time; ten o'clock is complete at half past eleven.
    log_streams.heartbeat(spark, f"{folder}/in", datetime(2024, 1, 1, 11, 35))
    (row,) = _summarize(spark, folder, delay="30 minutes").collect()
    assert (row.hour, row.error_count, row.unique_users) == (datetime(2024, 1, 1, 10), 4, 2)
    assert (row.avg_response_time, row.max_response_time, row.min_response_time) == (2.0, 4.0, 1.0)
    # Too late for ten o'clock, in time for eleven.
    lines(f"{folder}/in", [_line("2024-01-01 10:59:00", 5), _line("2024-01-01 11:40:00", 6, time=None)])
    log_streams.heartbeat(spark, f"{folder}/in", datetime(2024, 1, 1, 13, 0))
    rows = sorted(_summarize(spark, folder, delay="30 minutes").collect(), key=lambda r: r.hour)
    assert [(r.hour.hour, r.error_count) for r in rows] == [(10, 4), (11, 1)]
    assert rows[1].avg_response_time is None


def test_small_batches_give_the_batch_result(spark, folder):
    adapters.logs(spark, SMALL).repartitionByRange(5, "timestamp").write.json(f"{folder}/in")
    _summarize(spark, folder, max_files=2, delay="31 days")
    log_streams.heartbeat(spark, f"{folder}/in", datetime(2024, 3, 20))
    got = _summarize(spark, folder, max_files=2, delay="31 days")
    want = logs.summarize_errors(logs_json.read_logs(spark, f"{folder}/in"))
    columns = ["hour", "endpoint", "error_count", "max_response_time", "min_response_time", "unique_users",
               F.round("avg_response_time", 6)]
    assert want.count() == got.count() > 100
    assert want.select(*columns).exceptAll(got.select(*columns)).count() == 0


def test_files_are_ingested_once(spark, folder, lines, database):
    table = f"{database}.raw_transactions"
    run = lambda at: transaction_streams.ingest_new_files(
        spark, f"{folder}/in", f"{folder}/landing", f"{folder}/checkpoint", table, at
    )
    start = datetime(2024, 2, 1)
    lines(f"{folder}/in", [HEADER, "1,7,10,USD,2024-01-01,failed", "2,7,0,USD,2024-01-01,failed"])
    lines(f"{folder}/in", [HEADER, "3,,10,USD,2024-01-01,failed", "4,7,10,USD,2024-01-01,failed"])
    assert run(start) == ["batch_20240201_000000"]
    assert [r.transaction_id for r in spark.table(table).collect()] == [1]
    lines(f"{folder}/in", [HEADER, "5,7,10,USD,2024-01-01,failed"])
    assert run(start + timedelta(hours=1)) == ["batch_20240201_010000"]
    assert sorted(r.transaction_id for r in spark.table(table).collect()) == [1, 5]
    assert run(start + timedelta(hours=2)) == []
    assert spark.table(table).count() == 2


def test_a_run_without_files_does_nothing(spark, folder, database):
    spark.createDataFrame([], "value string").write.text(f"{folder}/in")
    done = transaction_streams.ingest_new_files(
        spark, f"{folder}/in", f"{folder}/landing", f"{folder}/checkpoint", f"{database}.raw_transactions", datetime(2024, 2, 1)
    )
    assert done == []


def test_a_cut_off_promotion_is_made_up_for(spark, folder, lines, database):
    table = f"{database}.raw_transactions"
    lines(f"{folder}/in", [HEADER, "1,7,10,USD,2024-01-01,failed"])
    transaction_streams.land_files(
        spark, f"{folder}/in", f"{folder}/landing", f"{folder}/checkpoint", datetime(2024, 2, 1)
    ).awaitTermination()
    lines(f"{folder}/in", [HEADER, "2,7,10,USD,2024-01-01,failed"])
    done = transaction_streams.ingest_new_files(
        spark, f"{folder}/in", f"{folder}/landing", f"{folder}/checkpoint", table, datetime(2024, 2, 2)
    )
    assert done == ["batch_20240201_000000", "batch_20240202_000000"]
    assert sorted(r.transaction_id for r in spark.table(table).collect()) == [1, 2]


def test_runs_of_one_second_and_rejected_files(spark, folder, lines, database):
    table = f"{database}.raw_transactions"
    run = lambda: transaction_streams.ingest_new_files(
        spark, f"{folder}/in", f"{folder}/landing", f"{folder}/checkpoint", table, datetime(2024, 2, 1)
    )
    lines(f"{folder}/in", [HEADER, "1,,10,USD,2024-01-01,failed"])
    assert run() == ["batch_20240201_000000"]  # nothing of it is accepted, and it is not tried again
    assert run() == [] and spark.table(f"{table}_quarantine").count() == 1
    lines(f"{folder}/in", [HEADER, "2,7,10,USD,2024-01-01,failed", "3,7,10,USD,2024-01-01,failed,more"])
    assert run() == ["batch_20240201_000000_2"]
    assert [r.transaction_id for r in spark.table(table).collect()] == [2]
    assert sorted(r.reason for r in spark.table(f"{table}_quarantine").collect()) == ["more fields than columns", "null values in user_id: 1"]
    assert subfolders(spark, f"{folder}/landing") == []


def test_redelivered_rows_go_and_nothing_else(spark, folder, lines):
    def run():
        transaction_streams.dedup_files(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", max_files=1).awaitTermination()
        return sorted(r.transaction_id for r in transaction_streams.deduplicated(spark, f"{folder}/out").collect())

    hot = "1,7,10,USD,2024-01-10 10:00:00,failed"
    for _ in range(3):
        lines(f"{folder}/in", [HEADER] + [hot] * 50 + ["2,7,10,USD,2024-01-10 11:00:00,failed", "3,7,10,USD,bad,failed", "x,7,10,USD,2024-01-10,failed", "y,8,10,USD,2024-01-10,failed"])
    assert run() == [1, 2]
    assert transaction_streams.deduplicated(spark, f"{folder}/out", "aside").count() == 9
    lines(f"{folder}/in", [HEADER, hot, "4,7,10,USD,2024-01-10 12:00:00,failed", "9,7,10,USD,2024-01-01 12:00:00,failed"])
    assert run() == [1, 2, 4, 9]  # a first delivery may come days late


def _dedup(spark, folder):
    transaction_streams.dedup_files(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return sorted(r.transaction_id for r in transaction_streams.deduplicated(spark, f"{folder}/out").collect())


def test_redeliveries_are_found_in_the_ledger_by_any_session(spark, folder, lines, monkeypatch):
    opened = []
    real = transaction_streams.KeyLedger.known
    monkeypatch.setattr(transaction_streams.KeyLedger, "known", lambda *a, **k: opened.append(real(*a, **k)) or opened[-1])
    for start in (1, 101, 201):
        lines(f"{folder}/in", [HEADER] + [f"{i},7,10,USD,2024-01-10,failed" for i in range(start, start + 100)])
        _dedup(spark, folder)
    assert opened == [None] * 3  # other ids: no file of the ledger is opened
    # a session whose catalog does not know the ledger's tables finds them by their folders
    ids = transaction_streams.delivered_ids(spark, f"{folder}/out")
    for name in {r["table"] for r in ids.loads().values()}:
        spark.sql(f"DROP TABLE {name}")
    lines(f"{folder}/in", [HEADER, "150,7,10,USD,2024-01-10,failed", "301,7,10,USD,2024-01-10,failed"])
    assert _dedup(spark, folder) == list(range(1, 302)) and opened[-1] is not None


def test_a_micro_batch_that_is_repeated_and_output_older_than_the_ledger(spark, folder, lines, monkeypatch):
    lines(f"{folder}/in", [HEADER, "1,7,10,USD,2024-01-10,failed"])
    assert _dedup(spark, folder) == [1]
    remove(spark, f"{folder}/out/ids")  # as if written before there was a ledger
    for name in [r.tableName for r in spark.sql("SHOW TABLES LIKE 'delivered_*'").collect()]:
        spark.sql(f"DROP TABLE {name}")
    lines(f"{folder}/in", [HEADER, "1,7,10,USD,2024-01-10,failed", "2,7,10,USD,2024-01-10,failed"])
    real = transaction_streams.KeyLedger.add

    def add_and_stop(self, keys, dead=(), merge=True):
        real(self, keys, dead, merge)
        if {"1"} & {b for r in self.loads().values() for b in r["batches"]}:
            raise OSError("lost")

    monkeypatch.setattr(transaction_streams.KeyLedger, "add", add_and_stop)
    with pytest.raises(Exception, match="lost"):
        _dedup(spark, folder)
    monkeypatch.undo()
    assert _dedup(spark, folder) == [1, 2]
    ids = transaction_streams.delivered_ids(spark, f"{folder}/out").rows().collect()
    assert sorted((r.key, r.batch_id) for r in ids) == [(1, "0"), (2, "1")]


def test_lines_without_an_hour_are_kept_and_late_ones_counted(spark, folder, lines):
    lines(f"{folder}/in", [_line("2024-01-01 10:05:00"), _line("not a time"), "bad line"])
    log_streams.keep_unplaced_lines(spark, f"{folder}/in", f"{folder}/aside", f"{folder}/aside-checkpoint").awaitTermination()
    assert sorted(r.reason for r in spark.read.parquet(f"{folder}/aside").collect()) == ["not a record", "time does not parse"]
    start = lambda: log_streams.summarize_new_files(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", delay="30 minutes")
    assert log_streams.finish(start()) == 0
    log_streams.heartbeat(spark, f"{folder}/in", datetime(2024, 1, 1, 15))
    assert log_streams.finish(start()) == 0
    lines(f"{folder}/in", [_line("2024-01-01 10:06:00")])
    with pytest.raises(log_streams.LateRowsError, match="1 rows"):
        log_streams.finish(start(), fail_on_late=True)


def _merge(spark, folder, **options):
    hours.merge_new_files(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", **options).awaitTermination()
    return hours.HourlyErrors(spark, f"{folder}/out")


def test_late_rows_change_their_hour_and_no_other(spark, folder, lines):
    lines(f"{folder}/in", [_line("2024-01-01 10:05:00", 1), _line("2024-01-01 10:15:00", None, time=None), _line("2024-02-01 11:00:00", 2), "bad line",
                           _line("no time"), _line("2024-01-01 10:30:00", 1, status=404)])
    kept = _merge(spark, folder)
    row = {r.hour: r for r in kept.summary().collect()}[datetime(2024, 1, 1, 10)]
    assert (row.error_count, row.avg_response_time, row.unique_users) == (2, 1.0, 2)
    before = kept.record()["hours"]
    lines(f"{folder}/in", [_line("2024-01-01 10:59:00", 1, time=4.0), _line("2024-01-01 10:58:00", 5, endpoint=None)])  # a month late
    kept = _merge(spark, folder)
    rows = {(r.hour.month, r.endpoint): (r.error_count, r.avg_response_time, r.max_response_time, r.unique_users) for r in kept.summary().collect()}
    assert rows == {(1, "/a"): (3, 2.5, 4.0, 2), (1, None): (1, 1.0, 1.0, 1), (2, "/a"): (1, 1.0, 1.0, 1)}
    now = kept.record()
    assert now["hours"]["2024-02-01-11"] == before["2024-02-01-11"] and now["hours"]["2024-01-01-10"] != before["2024-01-01-10"]
    assert (now["lines"], now["errors"], now["aside"]) == (8, 5, 2)
    assert sorted(r.reason for r in kept.aside().collect()) == ["not a record", "time does not parse"]


def test_more_than_a_hundred_micro_batches_lose_nothing(spark, folder, monkeypatch):
    monkeypatch.setattr(periods, "MOST_PARTS", 3)
    kept = hours.HourlyErrors(spark, f"{folder}/out")
    rows = lambda i: spark.createDataFrame([(_line(f"2024-01-{1 + i % 3:02d} 10:00:00", i % 7),)] * 2 + [("bad",)], "value string").coalesce(1)
    reader = None
    for i in range(104):
        kept.merge(rows(i), i)
        if i % 40 == 0:
            kept.merge(rows(i), i)  # repeated after a loss: counted once
            reader = kept.summary()
    now = kept.record()
    assert (now["lines"], now["errors"], now["aside"], now["batch"]) == (312, 208, 104, 103)
    assert sorted((r.hour.day, r.error_count, r.unique_users) for r in kept.summary().collect()) == [(1, 70, 7), (2, 70, 7), (3, 68, 7)]
    assert all(len(of["state"]) <= 4 for of in now["hours"].values())
    kept.merge(rows(0), 104)
    reader = kept.summary()
    kept.merge(rows(0), 105)
    assert reader.count() == 3  # replaced folders can still be read


def test_a_merge_that_was_cut_off_is_repeated(spark, folder, lines, monkeypatch):
    kept = hours.HourlyErrors(spark, f"{folder}/out")
    rows = spark.createDataFrame([(_line("2024-01-01 10:00:00", 1),), ("bad",)], "value string")
    monkeypatch.setattr(hours.claims.Folder, "write", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        kept.merge(rows, 0)
    monkeypatch.undo()
    assert kept.summary().count() == 0 and kept.record()["batch"] == -1
    kept.merge(rows, 0)
    assert kept.summary().first().error_count == 1 and kept.aside().count() == 1


def test_merged_hours_equal_the_batch_summary(spark, folder):
    adapters.logs(spark, SMALL).repartition(5).write.json(f"{folder}/in")
    got = _merge(spark, folder, max_files=2).summary()
    want = logs.summarize_errors(logs_json.read_logs(spark, f"{folder}/in"))
    columns = ["hour", "endpoint", "error_count", "max_response_time", "min_response_time", "unique_users", F.round("avg_response_time", 6)]
    assert want.count() == got.count() > 100 and want.select(*columns).exceptAll(got.select(*columns)).count() == 0
