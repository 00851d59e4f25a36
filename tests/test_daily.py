"""The daily summary kept by deltas."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import aggregates
from tallyworks.plans import daily, warehouse
from tallyworks.session import remove
from tallyworks.sinks import periods, tables


@pytest.fixture
def table(database):
    return f"{database}.fact_transactions"


def _load(spark, table, *rows):
    """Rows of (id, user, day of January 2024, amount, status)."""
    frame = spark.createDataFrame([(i, u, 20240100 + d, Decimal(a), s) for i, u, d, a, s in rows], "transaction_id long, user_id long, date_id int, amount decimal(15,2), status string")
    tables.append(frame, table, cluster_by="date_id", checked=True)


def _same(spark, table, kept):
    days = warehouse.default_date_dimension(spark)
    want = aggregates.daily_summary(spark.table(table), days).collect()
    got = kept.summary(days).select("transaction_date", "status", "transaction_count", "total_amount", "average_amount", "unique_users").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    return len(got)


def test_late_rows_change_their_days_and_only_new_files_are_read(spark, table, monkeypatch):
    kept, read = daily.DailySummary(spark, table), []
    real = daily.DailySummary._partial
    monkeypatch.setattr(daily.DailySummary, "_partial", lambda self, paths: read.append(list(paths)) or real(self, paths))
    assert kept.update() == [] and kept.summary(warehouse.default_date_dimension(spark)).count() == 0 and not read
    _load(spark, table, (1, 1, 1, "1.10", "failed"), (2, 1, 2, "2.20", "failed"), (3, 2, 3, "3.30", "completed"))
    assert kept.update() == [20240101, 20240102, 20240103] and _same(spark, table, kept) == 3
    before = kept.record()["days"]
    # the same user again on the first day, which is not one more; another user; a new status
    _load(spark, table, (4, 1, 1, "0.05", "failed"), (5, 9, 1, "7.00", "failed"), (6, 9, 1, "7.00", "pending"))
    assert kept.update() == [20240101] and _same(spark, table, kept) == 4
    now = kept.record()["days"]
    assert {d for d in now if now[d] != before[d]} == {"20240101"}
    assert all("date_id=20240101" in p for p in read[-1]) and not set(read[-1]) & set(read[0])
    assert kept.update() == [] and len(read) == 2
    _load(spark, table, (7, 1, 1, "1", "failed"), (8, 1, 2, "1", "failed"))
    assert kept.update([20240102]) == [20240102] and kept.update() == [20240101]
    assert _same(spark, table, kept) == 4


def test_days_written_anew_or_deleted(spark, table):
    kept = daily.DailySummary(spark, table)
    _load(spark, table, (1, 1, 1, "1", "failed"), (2, 1, 2, "2", "failed"), (3, 2, 2, "2", "failed"))
    kept.update()
    remove(spark, f"{kept.home}/date_id=20240101")
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (date_id = 20240101)")
    remove(spark, f"{kept.home}/date_id=20240102")
    spark.catalog.refreshTable(table)
    _load(spark, table, (3, 2, 2, "5", "failed"))
    assert kept.update() == [20240101, 20240102] and _same(spark, table, kept) == 1
    assert list(kept.record()["days"]) == ["20240102"]


def test_many_loads_steps_and_readers(spark, table, monkeypatch):
    monkeypatch.setattr(periods, "MOST_PARTS", 2)
    monkeypatch.setattr(daily, "FILES_PER_STEP", 1)
    kept, days, reader = daily.DailySummary(spark, table), warehouse.default_date_dimension(spark), None
    for i in range(5):
        _load(spark, table, *[(i * 10 + d, i % 2, d, "1.01", "failed") for d in (1, 2, 3)])
        if i == 4:
            reader = kept.summary(days)
        kept.update()
        assert _same(spark, table, kept) == 3
    assert sum(r.transaction_count for r in reader.collect()) == 12  # the frame of before the last update
    assert all(len(of["state"]) <= 3 for of in kept.record()["days"].values())


def test_an_update_that_was_cut_off_is_repeated(spark, table, monkeypatch):
    kept = daily.DailySummary(spark, table)
    _load(spark, table, (1, 1, 1, "1", "failed"))
    kept.update()
    _load(spark, table, (2, 2, 1, "1", "failed"))
    real = daily.claims.Folder.write
    monkeypatch.setattr(daily.claims.Folder, "write", lambda self, name, value: (_ for _ in ()).throw(OSError("lost")) if name == "now" else real(self, name, value))
    with pytest.raises(OSError):
        kept.update()
    monkeypatch.undo()
    assert kept.summary(warehouse.default_date_dimension(spark)).first().transaction_count == 1
    assert kept.update() == [20240101] and _same(spark, table, kept) == 1


def test_days_unknown_to_the_dimension_and_null_users(spark, table):
    kept = daily.DailySummary(spark, table)
    frame = spark.sql("select 1L as transaction_id, cast(null as bigint) as user_id, 20240101 as date_id, 1.5BD as amount, 'failed' as status union all select 2L, 3L, 19990101, 1.5BD, 'failed'")
    tables.append(frame, table, cluster_by="date_id", checked=True)
    kept.update()
    row = kept.summary(warehouse.default_date_dimension(spark)).first()
    assert (row.transaction_date, row.transaction_count, row.unique_users) == (date(2024, 1, 1), 1, 0) and _same(spark, table, kept) == 1
    assert spark.table(table).where(F.col("date_id") == 19990101).count() == 1
