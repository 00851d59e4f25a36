"""Cleaning rules, each with rows that a naive form would get wrong."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.functions import aggregates as fa
from tallyworks.functions import dates, parsing
from tallyworks.operators import chunks, clean, filters
from tallyworks.plans import warehouse
from tallyworks.schemas import DIM_USERS, FACT_TRANSACTIONS, NA_VALUES, VALID_STATUSES

RUN = datetime(2024, 5, 6, 7, 8, 9)


def one(spark, column, *values, kind="string"):
    """Apply a column function to the values, in order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


def test_transform_keeps_good_rows_and_stamps_them(spark):
    rows = spark.createDataFrame(
        [
            (1, 100.5, "2023-01-01", "COMPLETED"),
            (2, 200.75, "2023-01-02", "failed"),
            (3, -50.0, "2023-01-03", "invalid_status"),
        ],
        "user_id int, amount double, transaction_date string, status string",
    )
    out = clean.transform_transactions(rows, RUN)
    assert {"processed_at", "batch_id"} <= set(out.columns)
    got = [(r.user_id, r.amount, r.status, r.processed_at, r.batch_id) for r in out.orderBy("user_id").collect()]
    assert got == [
        (1, Decimal("100.50"), "completed", RUN, "batch_20240506_070809"),
        (2, Decimal("200.75"), "failed", RUN, "batch_20240506_070809"),
    ]


def test_rules_apply_to_present_columns_only(spark):
    out = clean.transform_transactions(spark.createDataFrame([(1, "x")], "id int, note string"), RUN)
    assert out.columns == ["id", "note", "processed_at", "batch_id"]
    assert out.count() == 1


def test_numbers(spark):
    texts = ["12.5", " 7 ", "1e3", ".5", "5.", "+1", "-2", "1d", "1f", "NaN", "inf", "Infinity", "0x10", "", "abc", None]
    got = one(spark, parsing.parse_number, *texts)
    assert got == [12.5, 7.0, 1000.0, 0.5, 5.0, 1.0, -2.0] + [None] * 9


def test_nan_is_not_positive(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("inf"),), (0.0,), (0.004,), (None,)], "amount double")
    kept = filters.positive_amount(clean.parse_amount(rows))
    assert [r.amount for r in clean.amount_to_money(kept).collect()] == [Decimal("0.00")]


def test_amount_beyond_the_table_is_null_so_validation_sees_it(spark):
    rows = spark.createDataFrame([("1e14", "pending"), ("1e999", "pending")], "amount string, status string")
    out = clean.transform_transactions(rows, RUN)
    assert [r.amount for r in out.collect()] == [None, None]


def test_missing_value_spellings(spark):
    assert one(spark, parsing.na_to_null, "NA", "n/a", "null", "", "<NA>", "none", "x", None) == [
        None, None, None, None, None, "none", "x", None,
    ]


def test_no_missing_value_spelling_parses(spark):
    for parse in (parsing.parse_number, parsing.parse_id, parsing.parse_timestamp):
        assert one(spark, parse, *NA_VALUES) == [None] * len(NA_VALUES)


def test_dates(spark):
    got = one(spark, parsing.parse_timestamp, "2023-01-01", "2023-01-02 03:04:05.123456789", "2023-02-30", "01/02/2023", "x")
    assert got == [datetime(2023, 1, 1), datetime(2023, 1, 2, 3, 4, 5, 123456), None, None, None]
    got = one(spark, lambda c: parsing.parse_timestamp(c, ["dd/MM/yyyy", "MM/dd/yyyy"]), "01/02/2023", "01/20/2023")
    assert got == [datetime(2023, 2, 1), datetime(2023, 1, 20)]


def test_status_loses_all_white_space(spark):
    got = one(spark, parsing.normalize_status, "\t Failed\n", " PENDING　", "in valid", None)
    assert got == ["failed", "pending", "in valid", None]


def test_ids(spark):
    assert one(spark, parsing.parse_id, "12", "12.0", "9007199254740993", "x", None) == [12, 12, 9007199254740993, None, None]


def test_strict_and_lenient_log_times(spark):
    assert one(spark, parsing.log_timestamp, "2024-01-02 03:04:05", None) == [datetime(2024, 1, 2, 3, 4, 5), None]
    assert one(spark, lambda c: parsing.log_timestamp(c, strict=False), "2024-01-02T03:04:05") == [None]
    assert one(spark, parsing.log_timestamp_infer, "2024-01-02T03:04:05") == [datetime(2024, 1, 2, 3, 4, 5)]
    with pytest.raises(Exception, match="not in the expected format"):
        one(spark, parsing.log_timestamp, "2024-01-02T03:04:05")
    with pytest.raises(Exception, match="cannot be parsed"):
        one(spark, parsing.log_timestamp_infer, "yesterday")


def test_strict_times_do_not_depend_on_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not in the expected format"):
            one(spark, parsing.log_timestamp, "bad")
        assert one(spark, parsing.parse_number, "abc", "1") == [None, 1.0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_endpoint_and_agent(spark):
    assert one(spark, parsing.endpoint_path, "GET /api/v1.0/a-b_c?x=/y", "none", "/", None) == ["/api/v1.0/a-b_c", None, None, None]
    assert one(spark, parsing.short_user_agent, "é" * 150, "short") == ["é" * 100, "short"]


def test_hour_floor_stays_clear_of_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # The hour from two to three does not exist there on this day.
        rows = spark.sql("select cast('2024-03-10 02:59:59.999999' as timestamp_ntz) as t")
        out = rows.select(dates.hour_floor(F.col("t")).alias("h"), dates.date_key(F.col("t")).alias("k"))
        assert out.select(F.col("h").cast("string"), "k").first() == ("2024-03-10 02:00:00", 20240310)
        assert dict(out.dtypes)["h"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_parts(spark):
    days = spark.createDataFrame([(date(2023, 1, 1),), (date(2024, 9, 4),)], "full_date date")
    rows = {r.date_id: r for r in warehouse.date_dimension(days).collect()}
    sunday = rows[20230101]
    assert (sunday.day_of_week, sunday.day_name, sunday.month_name, sunday.is_weekend) == (7, "Sunday   ", "January  ", True)
    wednesday = rows[20240904]
    assert (wednesday.day_of_week, wednesday.quarter, wednesday.day_name, wednesday.is_weekend) == (3, 3, "Wednesday", False)
    assert {r.day_name for r in warehouse.date_dimension(days, trim_names=True).collect()} == {"Sunday", "Wednesday"}


def test_default_date_dimension(spark):
    dim = warehouse.default_date_dimension(spark)
    assert dim.count() == 1826
    assert dim.agg(F.min("full_date"), F.max("full_date")).first() == (date(2023, 1, 1), date(2027, 12, 31))


def test_defaults_fill_omitted_columns_only(spark):
    rows = spark.createDataFrame([(1, None)], "user_id bigint, is_current boolean")
    out = clean.column_defaults(rows, DIM_USERS).first()
    assert (out.is_current, out.valid_to, out.user_name) == (None, date(9999, 12, 31), None)
    assert out.created_at is not None
    fact = clean.column_defaults(rows.select("user_id"), FACT_TRANSACTIONS, created_at=clean.timestamp_literal(RUN))
    assert (fact.first().currency, fact.first().created_at) == ("USD", RUN)


def test_zero_is_cleaned_away_but_no_quality_problem(spark):
    rows = spark.createDataFrame([(0.0,), (-1.0,), (1.0,)], "amount double")
    assert filters.positive_amount(rows).count() == 1
    assert filters.negative_amount(rows).count() == 1


def test_null_status_is_neither_valid_nor_reported(spark):
    rows = spark.createDataFrame([(s,) for s in (*VALID_STATUSES, "odd", None)], "status string")
    assert filters.valid_status(rows).count() == 4
    assert [r.status for r in filters.invalid_status(rows).collect()] == ["odd"]


def test_nunique_counts_null_once(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("a", None), ("b", None), ("c", 5)], "k string, v int")
    got = {r.k: r.n for r in rows.groupBy("k").agg(fa.nunique_with_null(F.col("v")).alias("n")).collect()}
    assert got == {"a": 2, "b": 1, "c": 1}
    assert rows.where("k = 'z'").agg(fa.nunique_with_null(F.col("v"))).first()[0] == 0


def test_chunk_number_counts_input_positions(spark):
    assert one(spark, lambda c: chunks.chunk_of(c, 10), 0, 9, 10, 25, kind="bigint") == [0, 0, 1, 2]


def test_exact_mean_of_decimals(spark):
    rows = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),), (Decimal("0.33"),), (None,)], "a decimal(15,2)")
    assert rows.agg(fa.exact_mean(F.col("a"))).first()[0] == 0.63 / 3
