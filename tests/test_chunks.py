"""Chunk acceptance against a plain Python account of the rule."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks.operators import chunks

SCHEMA = "n bigint, user_id bigint, amount double, transaction_date timestamp_ntz"
NOW = datetime(2024, 1, 1)


def _split(frame, **options):
    good, bad = chunks.split_chunks(frame, **options)
    return sorted(r.n for r in good.collect()), sorted(r.n for r in bad.collect())


def test_one_null_rejects_the_chunk(spark):
    rows = spark.createDataFrame(
        [(0, 1, 1.0, NOW), (1, None, 1.0, NOW), (2, 1, 1.0, NOW), (3, 1, 1.0, NOW)], SCHEMA
    ).withColumn("chunk_id", chunks.chunk_of(F.col("n"), 2))
    assert _split(rows) == ([2, 3], [0, 1])
    assert _split(rows, unit="row") == ([0, 2, 3], [1])
    assert _split(rows, rejected=chunks.rejected_chunks(rows)) == ([2, 3], [0, 1])
    reasons = {r.reason for r in chunks.quarantine_rows(rows).collect()}
    assert reasons == {"null values in user_id: 1"}


def test_missing_required_column_rejects_everything(spark):
    rows = spark.createDataFrame([(1, 100.5), (2, 200.75)], "user_id int, amount double").withColumn("chunk_id", F.lit(0))
    good, bad = chunks.split_chunks(rows)
    assert good.count() == 0
    assert [r.reason for r in bad.collect()] == ["missing required columns: transaction_date"] * 2


def test_complete_input_is_accepted(spark):
    rows = spark.createDataFrame(
        [(1, 100.5, NOW), (2, 200.75, NOW)], "user_id int, amount double, transaction_date timestamp_ntz"
    ).withColumn("chunk_id", F.lit(0))
    assert chunks.validate_chunks(rows).count() == 2
    assert chunks.validate_chunks(rows, rejected=chunks.rejected_chunks(rows)).count() == 2
    assert chunks.quarantine_rows(rows, rejected=chunks.rejected_chunks(rows)).count() == 0


def test_rows_without_a_position_form_their_own_chunk(spark):
    rows = spark.createDataFrame([(None, None, 1.0, NOW), (None, 2, 1.0, NOW), (5, 3, 1.0, NOW)], SCHEMA)
    rows = rows.withColumn("chunk_id", chunks.chunk_of(F.col("n"), 2))
    good, bad = chunks.split_chunks(rows)
    assert [r.user_id for r in good.collect()] == [3]
    assert bad.count() == 2


def test_report_knows_chunks_nothing_is_left_of(spark):
    source = spark.createDataFrame([(i, 1, 1.0, NOW) for i in range(6)], SCHEMA)
    source = source.withColumn("chunk_id", chunks.chunk_of(F.col("n"), 2))
    left = source.where("n >= 2").withColumn("user_id", F.when(F.col("n") != 4, F.col("user_id")))
    got = {r.chunk_id: (r.input_rows, r.kept_rows, r.bad_rows, r.accepted) for r in chunks.chunk_report(source, left).collect()}
    assert got == {0: (2, 0, 0, False), 1: (2, 2, 0, True), 2: (2, 2, 1, False)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.booleans(), st.booleans()), min_size=1, max_size=40), st.integers(1, 7))
def test_agrees_with_a_loop(spark, nulls, size):
    data = [(i, None if u else 1, None if a else 1.0, None if d else NOW) for i, (u, a, d) in enumerate(nulls)]
    want = []
    for start in range(0, len(data), size):
        part = data[start : start + size]
        if all(None not in row for row in part):
            want += [row[0] for row in part]
    rows = spark.createDataFrame(data, SCHEMA).withColumn("chunk_id", chunks.chunk_of(F.col("n"), size))
    good, bad = _split(rows)
    assert good == want
    assert sorted(good + bad) == list(range(len(data)))
