"""New transaction files: landing and promotion, and removal of re-delivered rows."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators import chunks, clean
from tallyworks.plans.transactions import store_landed
from tallyworks.schemas import TRANSACTIONS_CSV
from tallyworks.session import remove, scratch, subfolders, written
from tallyworks.sinks.ledger import KeyLedger
from tallyworks.sources.transactions_csv import CSV_OPTIONS, SURPLUS, mark_surplus, with_surplus


def _files(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    """Rows of new files as text, with ``surplus_line``."""
    reader = spark.readStream.schema(with_surplus(TRANSACTIONS_CSV)).options(**CSV_OPTIONS)
    reader = reader.option("columnNameOfCorruptRecord", SURPLUS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return mark_surplus(reader.csv(path), len(TRANSACTIONS_CSV))


def _each_batch(rows: DataFrame, checkpoint: str, store) -> StreamingQuery:
    """Hand every micro-batch to ``store`` with its number; a repeated one has the same number and replaces its folder."""
    return rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def land_files(
    spark: SparkSession,
    input_path: str,
    landing_path: str,
    checkpoint: str,
    run_ts: datetime,
    max_files: int | None = None,
    batch_id: str | None = None,
) -> StreamingQuery:
    """Type and stamp the rows of all new files and land them, with their file as the chunk. No shuffle.

    Rows that the cleaning rules drop are dropped here; lines with surplus fields are landed for the quarantine.
    """
    batch_id = batch_id or clean.batch_name(run_ts)
    source = chunks.with_chunk(_files(spark, input_path, max_files)).withColumn("_line", F.col(SURPLUS)).drop(SURPLUS)
    parsed = clean.parse_transactions(source)
    parsed = parsed.where(F.col("_line").isNotNull() | clean.kept_by_rules(parsed))
    landed = clean.stamp_batch(clean.amount_to_money(parsed), run_ts, batch_id)

    def store(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{landing_path}/{batch_id}/{number}")

    return _each_batch(landed, checkpoint, store)


def _promotions(spark: SparkSession, table: str) -> str:
    name = f"{table}_promotions"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (batch_id STRING, accepted BIGINT, quarantined BIGINT) USING parquet")
    return name


def promote(spark: SparkSession, landing_path: str, table: str, quarantine_table: str | None = None) -> list[str]:
    """Validate landed batches by file; accepted rows go to the raw table, all others to the quarantine.

    A batch is recorded once both are stored, and what was landed is deleted then, so nothing is read twice. A
    promotion that was cut off can simply be repeated: each batch is replaced as a whole.
    """
    ledger = _promotions(spark, table)
    pending = subfolders(spark, landing_path)
    done = {r["batch_id"] for r in spark.table(ledger).where(F.col("batch_id").isin(*pending)).select("batch_id").collect()}
    promoted = []
    for batch_id in pending:  # as a rule one: the run that just ended
        folder = f"{landing_path}/{batch_id}"
        landed = spark.read.parquet(*[f"{folder}/{n}" for n in subfolders(spark, folder)])
        if batch_id not in done and not landed.isEmpty():
            with scratch(spark, "promote") as own:
                counts = store_landed(landed, table, batch_id, quarantine_table or f"{table}_quarantine", f"{own}/rejected")
            note = spark.createDataFrame([(batch_id, counts["accepted"], counts["quarantined"])], spark.table(ledger).schema)
            note.coalesce(1).write.insertInto(ledger)
            promoted.append(batch_id)
        remove(spark, folder)
    return promoted


def ingest_new_files(
    spark: SparkSession,
    input_path: str,
    landing_path: str,
    checkpoint: str,
    table: str,
    run_ts: datetime,
    max_files: int | None = None,
    quarantine_table: str | None = None,
) -> list[str]:
    """One run over the files that arrived since the last one; returns the batches promoted.

    A run that shares its second with one already promoted gets a batch of its own, with a number behind the name.
    """
    name = clean.batch_name(run_ts)
    taken = {r["batch_id"] for r in spark.table(_promotions(spark, table)).where(F.col("batch_id").startswith(name)).select("batch_id").collect()}
    batch_id = next(b for b in (name, *(f"{name}_{i}" for i in range(2, len(taken) + 3))) if b not in taken)
    land_files(spark, input_path, landing_path, checkpoint, run_ts, max_files, batch_id).awaitTermination()
    return promote(spark, landing_path, table, quarantine_table)


def without_redeliveries(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """One row of each ``transaction_id`` that ``known`` does not hold.

    The copies of an id are first combined where they are read, so an id that fills a third of the input sends one row
    per task.
    """
    fresh = rows.dropDuplicates(["transaction_id"])
    return fresh if known is None else fresh.join(known, "transaction_id", "left_anti")


def delivered_ids(spark: SparkSession, output_path: str) -> KeyLedger:
    """The ledger of the ids in ``output_path``/rows, below the same folder."""
    name = f"delivered_{hashlib.sha256(output_path.encode()).hexdigest()[:16]}"
    return KeyLedger(spark, name, "ids", place=f"{output_path}/ids")


def _delivered(rows: DataFrame, batch: Column) -> DataFrame:
    return rows.select(F.col("transaction_id").cast("bigint").alias("key"), batch.alias("batch_id"), F.lit(1).cast("bigint").alias("n"))


def dedup_files(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Typed rows of new files without re-delivered transactions, in ``output_path``/rows.

    However late a first delivery comes, it appears, and however late a repeated one comes, it does not: ids are looked
    up in a ledger of those written, of which only files that may hold a new id are opened. A micro-batch that is
    repeated after a loss replaces its rows and its ids. Rows without an id or a valid time, and lines with surplus
    fields, go to ``output_path``/aside.
    """
    source = _files(spark, input_path, max_files).withColumn("_line", F.col(SURPLUS)).drop(SURPLUS)
    typed = clean.amount_to_money(clean.parse_transactions(source))
    ids = delivered_ids(spark, output_path)

    def store(rows: DataFrame, number: int) -> None:
        with scratch(spark, "dedup") as own:
            rows = written(rows, f"{own}/rows")
            odd = F.col("transaction_id").isNull() | F.col("transaction_date").isNull() | F.col("_line").isNotNull()
            rows.where(odd).write.mode("overwrite").parquet(f"{output_path}/aside/{number}")
            earlier = [n for n in subfolders(spark, f"{output_path}/rows") if n != str(number)]
            if earlier and not ids.exists():  # written before there was a ledger
                for n in earlier:
                    ids.add(_delivered(spark.read.schema(rows.schema).parquet(f"{output_path}/rows/{n}"), F.lit(n)))
            good = rows.where(~odd)
            met = ids.known(_delivered(good, F.lit(str(number))), without=[str(number)])
            known = None if met is None else written(met.select(F.col("key").alias("transaction_id")).distinct(), f"{own}/known")
            without_redeliveries(good, known).drop("_line").write.mode("overwrite").parquet(f"{output_path}/rows/{number}")
            stored = spark.read.schema(rows.schema).parquet(f"{output_path}/rows/{number}")
            before = [(load, str(number)) for load, r in ids.loads().items() if str(number) in r["batches"]]
            ids.add(_delivered(stored, F.lit(str(number))), dead=before)

    return _each_batch(typed, checkpoint, store)


def deduplicated(spark: SparkSession, output_path: str, part: str = "rows") -> DataFrame:
    """What ``dedup_files`` wrote: its ``rows``, or those put ``aside``."""
    return spark.read.parquet(*[f"{output_path}/{part}/{n}" for n in subfolders(spark, f"{output_path}/{part}")])
