"""The gate by kept figures, and appends against a ledger of keys."""

import glob

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import integrity, quality
from tallyworks.plans import verdicts
from tallyworks.sinks import ledger, tables
from tallyworks.sinks.ledger import location

ROW = "transaction_id bigint, user_id bigint, amount decimal(15,2), status string"


def _store(spark, table, batch, rows):
    from decimal import Decimal

    frame = spark.createDataFrame([(i, 1, None if a is None else Decimal(a), s) for i, a, s in rows], ROW)
    tables.overwrite_batch(frame.withColumn("batch_id", F.lit(batch)), table, batch)


def _same(spark, table):
    """The verdict from the kept figures equals that of the whole table."""
    key = lambda r: r["check"]
    kept = sorted((r.asDict() for r in verdicts.report(spark, table).collect()), key=key)
    whole = sorted((r.asDict() for r in quality.quality_report(spark.table(table)).collect()), key=key)
    assert kept == whole
    return {r["check"]: r["passed"] for r in kept}


def test_verdict_of_kept_figures_is_that_of_the_table(spark, database, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_LOADS", 3)
    raw = f"{database}.raw_transactions"
    assert not _same(spark, raw)["raw_transactions not empty"]
    _store(spark, raw, "a", [(1, 5, "failed"), (2, 6, "pending"), (None, 1, "failed")])
    assert all(_same(spark, raw).values())
    _store(spark, raw, "b/1", [(3, -5, "odd"), (4, 6, "other"), (4, 6, "odd"), (None, 1, None)])
    assert not any(v for c, v in _same(spark, raw).items() if "not empty" not in c)
    _store(spark, raw, "c", [(2, 1, "failed"), (10, None, "failed"), (4, 1, "failed")])
    _same(spark, raw)
    _store(spark, raw, "b/1", [(3, 5, "failed")])  # replaced: its ids no longer count
    found = _same(spark, raw)
    assert found["Valid statuses"] and not found["No duplicate transactions"]
    _store(spark, raw, "c", [(2, 1, "failed")])
    _store(spark, raw, "d", [(2, 1, "failed"), (3, 1, "failed")])
    _same(spark, raw)
    _store(spark, raw, "d", [])  # a batch without rows goes
    _store(spark, raw, "c", [(20, 1, "failed")])
    assert all(_same(spark, raw).values())
    _store(spark, raw, "e", [(20, 1, "failed")])
    _store(spark, raw, "c", [(21, 1, "failed")])
    assert all(_same(spark, raw).values())
    tables.append(spark.sql("select 21L as transaction_id, 'c' as batch_id, 'x' as status"), raw)  # files added to a batch
    assert not _same(spark, raw)["No duplicate transactions"]


def test_only_new_batches_and_the_ledger_are_read(spark, database):
    raw = f"{database}.raw_transactions"
    for i in range(3):
        _store(spark, raw, f"b{i}", [(10 * i + k, 5, "failed") for k in range(10)])
        verdicts.gate(spark, raw)
    base = location(spark, raw).removeprefix("file:")
    for path in glob.glob(f"{base}/batch_id=*/*/part-*"):  # the old batches can no longer be read
        with open(path, "wb") as f:
            f.write(b"no parquet")
    _store(spark, raw, "b3", [(30, 5, "failed")])
    assert verdicts.gate(spark, raw)["checks"][0]["details"] == "Row count: 31"
    _store(spark, raw, "b4", [(31, 5, "failed"), (7, 5, "failed")])  # an id of an old batch
    with pytest.raises(quality.DataQualityError, match="1 duplicate"):
        verdicts.gate(spark, raw)
    with pytest.raises(Exception, match="(?i)parquet"):
        quality.gate(spark.table(raw))


def test_gates_that_run_together_agree(spark, database):
    from concurrent.futures import ThreadPoolExecutor

    raw = f"{database}.raw_transactions"
    _store(spark, raw, "a", [(k, 5, "failed") for k in range(10)])
    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(lambda _: verdicts.gate(spark, raw), range(3)))
    assert found[0] == found[1] == found[2] and _same(spark, raw)["No duplicate transactions"]


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_appends_look_keys_up_without_reading_the_table(spark, database, kind):
    name = f"{database}.kept"
    rows = lambda start, stop: spark.range(start, stop).selectExpr(f"cast(id as {kind}) as k", "id as v")
    tables.create_from_df(rows(0, 1), name, primary_key="k", key_ledger=True)
    assert tables.append(rows(0, 50), name) == 50
    for path in glob.glob(f"{location(spark, name).removeprefix('file:')}/part-*"):
        with open(path, "wb") as f:
            f.write(b"no parquet")
    assert tables.append(rows(50, 60), name) == 10
    with pytest.raises(integrity.IntegrityError, match="not a key"):
        tables.append(rows(70, 72).unionByName(rows(70, 71)), name)
    with pytest.raises(integrity.IntegrityError, match="NULL"):
        tables.append(rows(70, 71).selectExpr(f"cast(null as {kind}) as k", "v"), name)
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.append(rows(49, 51), name)  # a key that is met is looked up in the table


def test_appends_that_were_cut_off_can_be_repeated(spark, database, monkeypatch):
    name = f"{database}.kept"
    rows = spark.range(5).selectExpr("id as k", "id as v")
    tables.create_from_df(rows, name, primary_key="k")
    tables.append(rows.where("k < 2"), name)
    tables.keep_key_ledger(spark, name)
    tables.keep_key_ledger(spark, name)
    store = tables._insert
    monkeypatch.setattr(tables, "_insert", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        tables.append(rows.where("k >= 2"), name)
    monkeypatch.setattr(tables, "_insert", store)
    assert tables.append(rows.where("k >= 2"), name) == 3
    with pytest.raises(integrity.IntegrityError, match="exists"):
        tables.append(rows.where("k in (1)"), name)
    with pytest.raises(ValueError, match="no recorded key"):
        tables.keep_key_ledger(spark, f"{database}.dim_date") if not tables.key_of(spark, f"{database}.dim_date")[0] else tables.keep_key_ledger(spark, f"{database}.raw_transactions")
