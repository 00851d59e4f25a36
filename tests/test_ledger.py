"""Claims and key ledgers."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from tallyworks.sinks import claims, ledger
from tallyworks.sinks.claims import ClaimedError, Folder, claim


def test_records_are_whole_and_created_once(spark, folder):
    place = Folder(spark, folder)
    assert place.names() == [] and place.read("a") is None
    assert place.create("a", {"x": 1}) and not place.create("a", 2) and place.read("a") == {"x": 1}
    place.write("a", [1, "é"])
    assert place.read("a") == [1, "é"] and place.names() == ["a"]
    won = []
    threads = [threading.Thread(target=lambda i=i: place.create("one", i) and won.append(i)) for i in range(12)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(won) == 1 and place.read("one") == won[0]


def test_a_claim_is_held_by_one_at_a_time(spark, folder):
    inside, most = [], []

    def work():
        with claim(spark, folder, pause=0.01):
            inside.append(1)
            most.append(len(inside))
            time.sleep(0.05)
            inside.pop()

    threads = [threading.Thread(target=work) for _ in range(6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert most == [1] * 6
    with claim(spark, folder), pytest.raises(ClaimedError, match="held"), claim(spark, folder, wait=0.1):
        pass
    assert len(Folder(spark, folder).names()) <= 4


def test_a_lost_job_is_taken_over_and_a_slow_one_finds_out(spark, folder):
    with claim(spark, folder, expiry=600) as slow:
        Folder(spark, folder).write("claim-1", time.time() - 700)
        with claim(spark, folder, expiry=600, wait=1) as other:
            other.require()
            with pytest.raises(ClaimedError, match="taken over"):
                slow.require()
    with claim(spark, folder, expiry=0.4) as renewed:
        time.sleep(1.2)  # longer than the expiry, but renewed meanwhile
        with pytest.raises(ClaimedError), claim(spark, folder, expiry=0.4, wait=0):
            pass
        renewed.require()


@pytest.fixture
def book(spark, database):
    return ledger.KeyLedger(spark, f"{database}.fact_transactions")


def _keys(spark, start, stop, batch, step=1):
    return spark.range(start, stop, step).select(F.col("id").alias("key"), F.lit(batch).alias("batch_id"), F.lit(1).cast("long").alias("n"))


def _scanned(df):
    """Files opened by each scan of an executed frame."""
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "QueryStageExec" in name:
            return walk(node.plan())
        if name == "FileSourceScanExec":
            out.append(node.metrics().apply("numFiles").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_a_batch_of_other_ids_opens_few_files(spark, book, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_LOADS", 100)
    for i in range(50):
        book.add(_keys(spark, i * 100, (i + 1) * 100, f"b{i}"), merge=False)
    files = sum(len(r["files"]) for r in book.loads().values())
    assert book.known(_keys(spark, 5000, 5100, "new")) is None
    some = book.known(_keys(spark, 4990, 5100, "new"))
    assert sorted(r.key for r in some.collect()) == list(range(4990, 5000))
    assert sum(_scanned(some)) < files / 10
    # one key far below the others does not widen the range of all
    wide = book.known(_keys(spark, 5000, 5100, "new").unionByName(_keys(spark, 3, 4, "new")))
    assert [(r.key, r.batch_id) for r in wide.collect()] == [(3, "b0")] and sum(_scanned(wide)) < files / 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = some._jdf.queryExecution().sparkPlan().toString() + book.known(_keys(spark, 4990, 5100, "new"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan


def test_a_hundred_loads_leave_few_files_and_readers_undisturbed(spark, book, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_LOADS", 4)
    reader, most = None, 0
    for i in range(25):
        for j in range(4):
            book.add(_keys(spark, (4 * i + j) * 10, (4 * i + j + 1) * 10, f"b{4 * i + j}"))
            most = max(most, len(book.loads()))
        if i == 11:
            reader = book.rows()
            reader.count()
    assert most <= 4 + 1 and book.rows().count() == 1000
    assert sum(len(r["files"]) for r in book.loads().values()) <= 5 * 8
    assert {r.batch_id for r in book.known(_keys(spark, 0, 1000, "x", 7)).collect()} == {f"b{k // 10}" for k in range(0, 1000, 7)}
    # what a merge replaced can be read until the next one
    now = book.rows()
    book.merge()
    assert now.count() == 1000


def test_replaced_batches_do_not_count(spark, book):
    load = book.add(_keys(spark, 0, 10, "a").unionByName(_keys(spark, 10, 20, "b")))
    book.add(_keys(spark, 5, 8, "a"), dead=[(load, "a")])
    want = sorted([(k, "a") for k in range(5, 8)] + [(k, "b") for k in range(10, 20)])
    assert sorted((r.key, r.batch_id) for r in book.rows().collect()) == want
    assert sorted(r.key for r in book.of_batches(["a"]).collect()) == [5, 6, 7]
    assert book.known(_keys(spark, 0, 5, "x")) is None or book.known(_keys(spark, 0, 5, "x")).count() == 0
    assert book.known(_keys(spark, 10, 12, "x"), without=["b"]) is None or book.known(_keys(spark, 10, 12, "x"), without=["b"]).count() == 0
    book.merge()
    assert sorted((r.key, r.batch_id) for r in book.rows().collect()) == want and len(book.loads()) == 1


def test_buckets_grow_with_the_keys(spark, book, monkeypatch):
    monkeypatch.setattr(ledger, "KEYS_PER_BUCKET", 10)
    book.add(_keys(spark, 0, 100, "a"))
    book.merge()
    book.add(_keys(spark, 100, 300, "b"))
    assert {r["buckets"] for r in book.loads().values()} == {16}
    book.merge()
    assert {r["buckets"] for r in book.loads().values()} == {32}
    assert sorted(r.key for r in book.known(_keys(spark, 50, 400, "x", 50)).collect()) == [50, 100, 150, 200, 250]


def test_a_load_without_record_does_not_count(spark, book):
    book.add(_keys(spark, 0, 5, "a"))
    name = next(iter(book.loads().values()))["table"]
    spark.sql(f"insert into {name} values (77, 'cut off', 1, 'no-record')")
    assert book.rows().count() == 5 and book.known(_keys(spark, 77, 78, "x")) is None
