"""What the plans must and must not contain."""

import io
import pathlib
import re
from collections import Counter
from contextlib import redirect_stdout
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import aggregates, filters
from tallyworks.plans import reports, transactions, warehouse
from tallyworks.registry.queries import QUERIES
from tallyworks.session import materialize, setting, shared_dir
from tallyworks.sources import logs_json
from tests.conftest import SMALL

PACKAGE = pathlib.Path(__file__).parent.parent / "tallyworks"
# These write on the way to their result; what they do is covered by the others' plans.
LAZY = [
    k for k in QUERIES
    if not k.startswith(("src_", "sink_", "tbl_", "ddl_", "stream_", "run_", "ingest", "load", "build", "error_log", "daily_"))
] + ["src_sql_query"]


def plan(df, mode="simple"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("key", LAZY)
def test_no_python_and_no_cross_join(spark, key):
    text = plan(QUERIES[key](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_source_uses_no_shortcuts():
    source = "\n".join(p.read_text() for p in PACKAGE.rglob("*.py") if p.parent.name != "llm")
    for word in ("localCheckpoint", "crossJoin", ".toPandas", "pandas_udf", "F.udf", "broadcast(", ".rdd"):
        assert word not in source
    # Driver-side results: watermark, violation kinds, check rows, batch names and states, rule numbers, properties.
    assert len(re.findall(r"\.collect\(\)", source)) <= 12


@pytest.fixture(scope="module")
def fact(spark):
    path = shared_dir(spark, "plan-fact")
    rows = spark.range(1000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 50).alias("user_id"), F.lit("failed").alias("status"),
        F.expr("cast(1.5 as decimal(15,2))").alias("amount"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 30 as int))").alias("created_at"),
        (F.lit(20240101) + F.col("id") % 30).cast("int").alias("date_id"),
    )
    rows.write.partitionBy("date_id").parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_the_scan(spark, fact):
    text = plan(filters.recent_failures(fact, date(2024, 1, 31)).select("user_id"))
    assert "EqualTo(status,failed)" in text and "GreaterThanOrEqual(created_at," in text
    assert "amount" not in text.split("ReadSchema")[1]


def test_days_prune_folders(spark, fact):
    days = warehouse.default_date_dimension(spark).where("full_date = date'2024-01-05'")
    text = plan(aggregates.daily_summary(fact, days))
    assert "dynamicpruning" in text.lower()


def test_date_dimension_is_broadcast_by_its_size(spark, fact):
    text = plan(aggregates.daily_summary(fact, warehouse.default_date_dimension(spark)))
    assert "BroadcastHashJoin [date_id" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(aggregates.daily_summary(fact, warehouse.default_date_dimension(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_reads_the_fact_once_and_combines_before_the_shuffle(spark, fact):
    users = spark.range(50).selectExpr("id as user_id", "'n' as user_name", "'c' as user_category", "true as is_current")
    report = reports.failed_users(fact, users, date(2024, 1, 31))
    text = plan(report)
    assert text.count("FileScan parquet") == 1
    assert re.search(r"Exchange hashpartitioning\(user_id.*\n[^\n]*HashAggregate\(keys=\[user_id.*partial_count", text)
    recent = Counter(i % 50 for i in range(1000) if i % 30 >= 23)  # since 2024-01-24
    assert {r.user_id: r.failed_count for r in report.collect()} == {u: n for u, n in recent.items() if n > 3}


def test_watermark_is_a_subquery_of_the_filter(spark):
    rows = materialize(spark.sql("select timestamp_ntz'2024-01-01' as processed_at, 1 as n"), "w")
    text = plan(filters.since_watermark(rows, rows))
    assert "Subquery" in text and "PushedFilters" in text
    assert filters.since_watermark(rows, rows).count() == 1
    assert filters.since_watermark(rows, rows.where("n > 5")).count() == 1


def test_a_line_is_parsed_once_in_the_filter(spark, folder, lines):
    lines(folder, ["{}"])
    text = plan(logs_json.read_logs_tolerant(spark, folder), "formatted")
    (condition,) = re.findall(r"Condition : (.*?)\n\(\d+\) ", text, re.S)
    assert condition.count("from_json(StructField(timestamp") == 1


def test_missing_keys_need_no_sort_aggregate(spark):
    assert "SortAggregate" not in plan(QUERIES["join_anti_existing"](spark, SMALL))


def test_looking_up_ids_moves_only_the_new_ones(spark, database):
    fact = f"{database}.fact_transactions"
    ids = transactions._id_ledger(spark, fact)
    ids.add(transactions._keys(spark.range(20).selectExpr("id as transaction_id", "'b' as batch_id")))
    new = transactions._keys(spark.range(10).selectExpr("id as transaction_id", "'c' as batch_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ids.known(new))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ledger_side = text[text.index("FileScan") - 600 : text.index("FileScan")]
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1 and "Exchange" not in ledger_side.split("Sort [")[-1]


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert shared_dir(spark, "x").startswith(base.rstrip("/") + "/tallyworks/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_skewed_user_is_counted_whole(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("user_id"), F.lit("failed").alias("status"),
        F.expr("timestamp_ntz'2024-01-30'").alias("created_at"),
    )
    users = spark.range(30000).selectExpr("id as user_id", "'n' as user_name", "'c' as user_category", "true as is_current")
    got = reports.failed_users(rows, users, date(2024, 1, 31)).collect()
    assert [(r.user_id, r.failed_count, r.failure_rate) for r in got] == [(7, 10001, 100.0)]


def test_a_hot_gzip_file_is_spread_over_tasks(spark, folder):
    rows = spark.range(20000).select(F.format_string('{"timestamp":"2024-01-01 10:00:00","endpoint":"/%s","status_code":500}', F.sha2(F.col("id").cast("string"), 256)).alias("value"))
    rows.coalesce(1).write.option("compression", "gzip").text(folder)
    per_task = lambda df: sorted(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("endpoint").alias("n")).collect())
    assert not logs_json.has_hot_file(spark, folder)
    assert "Exchange" not in plan(logs_json.read_logs(spark, folder)) and per_task(logs_json.read_logs(spark, folder)) == [20000]
    with setting(spark, "spark.sql.files.maxPartitionBytes", "1MB"), setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB"):
        for scan in (logs_json.read_logs, logs_json.read_logs_tolerant):
            logs = scan(spark, folder)
            assert "REBALANCE" in plan(logs)
            spread = per_task(logs)
            assert len(spread) > 3 and spread[-1] < 10000 and sum(spread) == 20000
