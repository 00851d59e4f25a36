"""Quality checks, the gate, declarative checks and integrity."""

from datetime import datetime
from decimal import Decimal

import pytest

from tallyworks.operators import aggregates, integrity, quality
from tallyworks.plans import transactions, warehouse

SCHEMA = "transaction_id bigint, amount double, status string"


def test_report_of_good_data(spark):
    rows = spark.createDataFrame([(1, 0.0, "failed"), (2, 5.0, None)], SCHEMA)
    result = quality.gate(rows)
    assert result["is_valid"] is True and result["errors"] == []
    assert [c["check"] for c in result["checks"]] == [
        "raw_transactions not empty", "No negative amounts", "Valid statuses", "No duplicate transactions",
    ]
    assert [c["details"] for c in result["checks"]] == [
        "Row count: 2", "Negative amount count: 0", "Invalid status count: 0", "Duplicate count: 0",
    ]


def test_report_of_bad_data(spark):
    rows = spark.createDataFrame([(1, -1.0, "odd"), (1, 5.0, "new"), (None, 1.0, "odd"), (None, 1.0, "failed")], SCHEMA)
    result = quality.validate_transactions(rows)
    assert result["errors"] == [
        "Found 1 transactions with negative amounts",
        "Found invalid statuses: 2 different values in 3 rows",
        "Found 2 duplicate transactions",
    ]
    with pytest.raises(quality.DataQualityError, match="duplicate transactions"):
        quality.gate(rows)


def test_report_of_no_data(spark):
    result = quality.validate_transactions(spark.createDataFrame([], SCHEMA), "t")
    assert result["errors"] == ["Table t is empty"]


def test_a_check_that_cannot_run_is_a_failed_check(spark):
    result = quality.validate_transactions(spark.createDataFrame([(1, 2.0)], "transaction_id int, amount double"))
    failed = {c["check"]: c for c in result["checks"] if not c["passed"]}
    assert list(failed) == ["Valid statuses"] and "status" in failed["Valid statuses"]["error"]
    assert result["is_valid"] is False and len(result["checks"]) == 4


@pytest.mark.parametrize("n", [1, 100_000])
def test_invalid_statuses_read_alike_at_any_number(spark, n):
    rows = spark.range(n).selectExpr("id as transaction_id", "1D as amount", "concat('s', id) as status")
    check = quality.check_valid_status(rows).first()
    assert check.error == f"Found invalid statuses: {n} different values in {n} rows"
    assert aggregates.invalid_status_counts(rows).count() == n


def test_declarative_checks(spark):
    rows = spark.createDataFrame([(1, 5.0, "failed"), (1, 50.0, "odd"), (2, None, None)], SCHEMA)
    specs = [
        {"type": "not_empty"},
        {"type": "range", "column": "amount", "min": 0, "max": 10},
        quality.ACCEPTED_STATUS_CHECK,
        {"type": "not_null", "column": "amount"},
        {"type": "unique", "columns": ["transaction_id"]},
        {"type": "unique", "columns": ["transaction_id", "status"]},
    ]
    result = quality.run_checks(rows, specs)
    assert [c["passed"] for c in result["checks"]] == [True, False, False, False, False, True]
    assert result["success"] is False and len(result["errors"]) == 4
    assert quality.run_checks(rows, specs[:1])["success"] is True and quality.require_checks(rows, specs[:1])["success"]
    with pytest.raises(quality.DataQualityError, match="unique"):
        quality.require_checks(rows, specs)
    assert quality.run_checks(rows, [{"type": "not_null", "column": "gone"}, {"type": "not_empty"}])["errors"][0]


FACT = "transaction_id bigint, user_id bigint, date_id int, amount decimal(15,2), status string"


def test_integrity_names_every_violation(spark):
    one = Decimal("1.00")
    fact = spark.createDataFrame(
        [
            (1, 1, 20230101, one, "failed"),
            (2, 1, 20230101, one, "failed"),
            (2, 1, 20230101, one, "failed"),
            (3, 9, 19990101, one, "failed"),
            (None, None, None, None, None),
            (5, 1, 20230101, one, "failed"),
        ],
        FACT,
    )
    users = spark.createDataFrame([(1,)], "user_id bigint")
    target = spark.createDataFrame([(5,), (77,)], "transaction_id bigint")
    flagged = integrity.with_violations(fact, users, warehouse.default_date_dimension(spark), target)
    assert flagged.count() == 6
    got = {r.transaction_id: r.violations for r in flagged.collect()}
    assert got[1] == []
    assert got[2] == ["duplicate transaction_id"]
    assert got[3] == ["unknown user_id", "unknown date_id"]
    assert got[5] == ["transaction_id already loaded"]
    assert got[None] == [f"{c} is null" for c in ("transaction_id", "user_id", "date_id", "amount", "status")]
    assert [r.transaction_id for r in integrity.passing(flagged).collect()] == [1]


def test_created_at_is_load_time_or_event_time(spark):
    event, load = datetime(2024, 1, 2, 3), datetime(2024, 2, 1)
    raw = spark.createDataFrame(
        [(1, 1, Decimal("1.00"), event, "failed")],
        "transaction_id bigint, user_id bigint, amount decimal(15,2), transaction_date timestamp_ntz, status string",
    )
    by_load = transactions.to_fact(raw, load).first()
    assert (by_load.created_at, by_load.processed_at, by_load.currency, by_load.transaction_type) == (load, load, "USD", None)
    assert transactions.to_fact(raw, load, "event").first().created_at == event
    assert by_load.date_id == 20240102
