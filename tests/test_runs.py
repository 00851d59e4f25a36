"""Whole runs that are lost between two steps."""

from datetime import datetime, timedelta

import pytest

from tallyworks.plans import runs, transactions, verdicts, warehouse
from tallyworks.sinks import tables
from tallyworks.sinks.ledger import KeyLedger

HEADER = "transaction_id,user_id,amount,currency,transaction_date,status"
RUN = datetime(2024, 2, 1)


def _run(spark, database, path, at):
    users = spark.sql("select 1L as user_id, true as is_current")
    return transactions.run_all(
        spark, path, f"{database}.raw_transactions", f"{database}.fact_transactions", users, warehouse.default_date_dimension(spark), at, unit="row"
    )


def _tables(spark, database):
    read = lambda name, *columns: sorted(map(tuple, spark.table(f"{database}.{name}").select(*columns).collect()))
    ledger = KeyLedger(spark, f"{database}.fact_transactions", "ids").rows()
    return (
        read("raw_transactions", "transaction_id", "user_id"), read("raw_transactions_quarantine", "transaction_id", "reason"),
        read("fact_transactions", "transaction_id", "user_id", "date_id"), sorted({r.key for r in ledger.collect()}),
    )


FIRST = [HEADER, "1,1,10,USD,2024-01-01,failed", "2,,10,USD,2024-01-01,failed", "3,1,10,USD,2024-01-02,failed"]
OTHER = [HEADER, "4,1,10,USD,2024-01-01,failed"]
WANTED = ([(1, 1), (3, 1), (4, 1)], [(2, "null values in user_id")], [(1, 1, 20240101), (3, 1, 20240102), (4, 1, 20240101)], [1, 3, 4])

#: Where a run stops, each before or after the step does its work.
STEPS = [
    (tables, "overwrite_batch", True), (transactions, "_write_quarantine", False), (transactions, "_write_quarantine", True),
    (verdicts, "gate", False), (transactions, "load_fact_incremental", False), (transactions, "_note", True),
    (KeyLedger, "add", True), (tables, "append", True), (transactions, "load_fact_incremental", True),
]


def _stop(monkeypatch, owner, name, after):
    real = getattr(owner, name)

    def stopped(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise OSError("lost")

    monkeypatch.setattr(owner, name, stopped)


@pytest.mark.parametrize(("owner", "name", "after"), STEPS, ids=lambda v: getattr(v, "__name__", str(v)).split(".")[-1])
def test_the_next_run_makes_up_for_a_lost_one(spark, folder, lines, database, monkeypatch, owner, name, after):
    """The same input comes again an hour later, under another batch id, and then another input."""
    lines(f"{folder}/1", FIRST)
    lines(f"{folder}/2", OTHER)
    _stop(monkeypatch, owner, name, after)
    with pytest.raises(OSError, match="lost"):
        _run(spark, database, f"{folder}/1", RUN)
    monkeypatch.undo()
    _run(spark, database, f"{folder}/1", RUN + timedelta(hours=1))
    _run(spark, database, f"{folder}/2", RUN + timedelta(hours=2))
    assert _tables(spark, database) == WANTED
    assert runs.Journal(spark, f"{database}.raw_transactions").unfinished() == {}


@pytest.mark.parametrize("after", [False, True])
def test_another_input_comes_first(spark, folder, lines, database, monkeypatch, after):
    """A batch stored by half goes until its input comes again; one that was stored is loaded with the next."""
    lines(f"{folder}/1", FIRST)
    lines(f"{folder}/2", OTHER)
    _stop(monkeypatch, *((verdicts, "gate", False) if after else (transactions, "_write_quarantine", True)))
    with pytest.raises(OSError, match="lost"):
        _run(spark, database, f"{folder}/1", RUN)
    monkeypatch.undo()
    assert _run(spark, database, f"{folder}/2", RUN + timedelta(hours=1)) == (3 if after else 1)
    if not after:
        assert spark.table(f"{database}.raw_transactions_quarantine").count() == 0
        _run(spark, database, f"{folder}/1", RUN + timedelta(hours=2))
    assert _tables(spark, database) == WANTED


def test_inputs_are_told_apart_by_their_files(spark, folder, lines):
    lines(f"{folder}/1", OTHER)
    first = runs.signature(spark, f"{folder}/1", {})
    assert first == runs.signature(spark, [f"{folder}/1"], {}) != runs.signature(spark, f"{folder}/1", {"unit": "row"})
    lines(f"{folder}/1", OTHER)
    assert runs.signature(spark, f"{folder}/1", {}) != first and runs.signature(spark, f"{folder}/none", {}) != first
