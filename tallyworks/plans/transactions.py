"""Transaction jobs: ingest, quality gate, incremental fact load."""

from __future__ import annotations

import functools
import logging
import urllib.parse
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions.aggregates import watermark
from tallyworks.functions.dates import date_key
from tallyworks.operators import chunks, clean, integrity
from tallyworks.plans import runs, verdicts
from tallyworks.schemas import FACT_TRANSACTIONS, TRANSACTIONS_CSV
from tallyworks.session import scratch, written
from tallyworks.sinks import claims, tables
from tallyworks.sinks.ledger import KeyLedger, location
from tallyworks.sources.transactions_csv import SURPLUS, scan_transactions

logger = logging.getLogger(__name__)


def ingest_raw(
    spark: SparkSession,
    input_path: str | list[str],
    table: str,
    run_ts: datetime,
    batch_id: str | None = None,
    ordinal: str | None = None,
    chunk_rows: int = chunks.CHUNK_ROWS,
    unit: str = "chunk",
    quarantine_table: str | None = None,
    schema: T.StructType | None = TRANSACTIONS_CSV,
    multi_line: bool = False,
) -> dict[str, int]:
    """Scan, clean, validate and store transactions under the batch of this run; returns and logs what was counted.

    The text is read once: typed rows are landed in the shared folder, and acceptance, rejected chunks and counts come
    from there. Rejected rows and lines with surplus fields go to the quarantine, by default the table's name with
    ``_quarantine``, under the same batch. The batch identifies the run: repeating a run replaces its own rows. Two
    runs that start in the same second need batch ids of their own.
    """
    batch_id = batch_id or clean.batch_name(run_ts)
    read = Observation()
    source = scan_transactions(spark, input_path, schema=schema, ordinal=ordinal, chunk_rows=chunk_rows, multi_line=multi_line)
    source = source.observe(read, F.count("*").alias("rows"), F.count(SURPLUS).alias("surplus"))
    line = F.col(SURPLUS)
    parsed = clean.parse_transactions(source.withColumn("_line", line).drop(SURPLUS))
    parsed = parsed.where(F.col("_line").isNotNull() | clean.kept_by_rules(parsed))
    with scratch(spark, "ingest") as folder:
        landed = written(clean.stamp_batch(clean.amount_to_money(parsed), run_ts, batch_id), f"{folder}/rows")
        counted = store_landed(landed, table, batch_id, quarantine_table or f"{table}_quarantine", f"{folder}/rejected", unit)
    counts = {"rows_read": read.get["rows"], "surplus_lines": read.get["surplus"], **counted}
    log = logger.warning if counts["quarantined"] else logger.info
    log("batch %s of %s: %s", batch_id, table, counts)
    return counts


def store_landed(
    landed: DataFrame, table: str, batch_id: str, quarantine_table: str, rejected_path: str, unit: str = "chunk"
) -> dict[str, int]:
    """Split the landed rows of one batch, which may carry a surplus line in ``_line``, and store both parts.

    The rejected chunks are written down first, a handful of rows, so that both results join a frame of known size.
    """
    lines = landed.where(F.col("_line").isNotNull()).withColumn("reason", F.lit("more fields than columns"))
    fitting = landed.where(F.col("_line").isNull())
    whole_input = any(c not in landed.columns for c in chunks.REQUIRED_COLUMNS)
    rejected = None
    if unit == "chunk" and not whole_input:
        rejected = written(chunks.rejected_chunks(fitting), rejected_path)
    accepted, refused = chunks.split_chunks(fitting, unit=unit, rejected=rejected)
    with ThreadPoolExecutor(2) as pool:  # two tables, which the jobs of one run can fill side by side
        n_accepted = pool.submit(tables.overwrite_batch, accepted.drop(chunks.CHUNK_COLUMN, "_line"), table, batch_id)
        n_refused = pool.submit(_write_quarantine, refused.unionByName(lines).withColumnRenamed("_line", "line"), quarantine_table, batch_id)
    return {
        "accepted": n_accepted.result(), "quarantined": n_refused.result(), "rejected_chunks": rejected.count() if rejected is not None else 0,
    }


def _write_quarantine(rows: DataFrame, table: str, batch_id: str) -> int:
    spark = rows.sparkSession
    if chunks.CHUNK_COLUMN in rows.columns:
        rows = rows.withColumn(chunks.CHUNK_COLUMN, F.col(chunks.CHUNK_COLUMN).cast("string"))
    if not spark.catalog.tableExists(table):
        layout = [c for c in rows.columns if c != "batch_id"] + ["batch_id"]
        rows.select(*layout).limit(0).write.format("parquet").partitionBy("batch_id").saveAsTable(table)
    return tables.overwrite_batch(rows, table, batch_id)


def to_fact(raw: DataFrame, load_ts: datetime, created_at_source: str = "load", keep: Sequence[str] = ()) -> DataFrame:
    """Fact rows of raw rows; the columns a load does not fill get their defaults.

    ``created_at`` is the load time by default; ``'event'`` takes the time of the transaction.
    """
    now = clean.timestamp_literal(load_ts)
    picked = raw.select(
        "transaction_id", "user_id", date_key(F.col("transaction_date")).alias("date_id"), "amount", "status",
        F.col("transaction_date").alias("_event_time"), *keep,
    )
    created = F.col("_event_time") if created_at_source == "event" else now
    filled = clean.column_defaults(picked, FACT_TRANSACTIONS, created_at=created, processed_at=now)
    return filled.select(*[c for c, _ in FACT_TRANSACTIONS.columns], *keep)


# What was loaded: a record when the load of a batch starts and one when it is complete, and the ids with their batch.

STARTED, LOADED = "started", "loaded"
#: Records of single batches that may lie about before they are gathered into one.
LOOSE_RECORDS = 400


def _batch_records(spark: SparkSession, fact_table: str) -> claims.Folder:
    return claims.Folder(spark, f"{location(spark, fact_table)}_batch_records")


def _note(records: claims.Folder, batches: list[str], state: str, at: datetime, loaded: int | None = None) -> None:
    for b in batches:
        records.write(f"{state}-{urllib.parse.quote(b, safe='')}", {"at": at.isoformat(), "loaded_rows": loaded})


def _batch_states(records: claims.Folder) -> tuple[set[str], set[str]]:
    """Batches whose load started, and those whose load is complete: from one listing, and one record of older batches."""
    names, done = records.names(), set(records.read("all-loaded") or ())
    of = lambda state: {urllib.parse.unquote(n.removeprefix(f"{state}-")) for n in names if n.startswith(f"{state}-")}
    started, loaded = of(STARTED), of(LOADED)
    if len(names) > LOOSE_RECORDS:
        done |= loaded
        records.write("all-loaded", sorted(done))
        for b in loaded:
            for state in (STARTED, LOADED):
                records.delete(f"{state}-{urllib.parse.quote(b, safe='')}")
    return started - loaded - done, loaded | done


def _id_ledger(spark: SparkSession, fact_table: str) -> KeyLedger:
    """Ids of the fact with their batch. Made from the fact where it is missing; ids loaded before that have no batch."""
    ledger = KeyLedger(spark, fact_table, "ids")
    if not ledger.exists():
        ledger.add(_keys(spark.table(fact_table).withColumn("batch_id", F.lit(""))))
    return ledger


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("transaction_id").cast("bigint").alias("key"), "batch_id", F.lit(1).cast("bigint").alias("n"))


def new_raw_rows(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """Raw rows stamped at or after the fact's latest load, the reference's choice of what is new.

    A batch stamped before the last load but stored after it is never chosen; loading by batch has no such hole.
    """
    latest = fact.agg(watermark(F.col("processed_at")).alias("w")).first()["w"]
    return raw.where(F.col("processed_at") >= clean.timestamp_literal(latest))


def _write_keys(spark: SparkSession, sets: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Compute all key sets in one job, a folder each, and read back those that are not empty."""
    tagged = [
        keys.select(F.col(keys.columns[0]).cast("bigint").alias("key"), F.lit(i).alias("rule"))
        for i, keys in enumerate(sets.values())
    ]
    functools.reduce(DataFrame.unionByName, tagged).write.partitionBy("rule").parquet(path)
    found = {r["rule"] for r in spark.read.schema("key bigint, rule int").parquet(path).select("rule").distinct().collect()}
    return {
        text: spark.read.schema("key bigint").parquet(f"{path}/rule={i}").select(F.col("key").alias(keys.columns[0]))
        for i, (text, keys) in enumerate(sets.items())
        if i in found
    }


def load_fact_incremental(
    spark: SparkSession,
    raw_table: str,
    fact_table: str,
    dim_users: DataFrame,
    dim_date: DataFrame,
    load_ts: datetime,
    created_at_source: str = "load",
    on_violation: str = "fail",
    quarantine_table: str | None = None,
    choose: str = "batch",
) -> int:
    """Load the batches of the raw table that are not recorded as loaded; returns how many rows were loaded.

    ``on_violation='fail'`` loads nothing if any row breaks a constraint; ``'quarantine'`` loads the others, and the
    violating rows of a batch replace what an earlier load of it set aside. An id that another batch has loaded is a
    violation. A load that was cut off is made up for: rows of a started batch that the fact holds already are left out.
    ``choose='watermark'`` takes only rows stamped at or after the latest load, and refuses a load time that is not
    after the rows' own, for those would be chosen again.

    Loads of one fact table exclude each other, since ids must be unique over all batches: one waits until the other is
    done and then finds its batches loaded. A load that lost its claim stops before it stores anything.

    New rows and offending keys are written down first: the raw folders are read once, rules nothing breaks need no
    join, and the other joins are planned with true sizes. Known ids are looked up in a ledger, of which only files that
    may hold a new id are opened.
    """
    if on_violation not in ("fail", "quarantine") or choose not in ("batch", "watermark"):
        raise ValueError(f"unknown mode: {on_violation}, {choose}")
    with claims.claim(spark, f"{location(spark, fact_table)}_load_claims") as held, scratch(spark, "load") as folder:
        return _load(spark, raw_table, fact_table, dim_users, dim_date, load_ts, created_at_source, on_violation, quarantine_table, choose, held, folder)


def _load(
    spark: SparkSession, raw_table: str, fact_table: str, dim_users: DataFrame, dim_date: DataFrame, load_ts: datetime,
    created_at_source: str, on_violation: str, quarantine_table: str | None, choose: str, held: claims.Claim, folder: str,
) -> int:
    fact, raw = spark.table(fact_table), spark.table(raw_table)
    records = _batch_records(spark, fact_table)
    started, loaded = _batch_states(records)
    pending = sorted(set(tables.stored_batches(spark, raw_table)) - loaded)
    if not pending:
        return 0
    ids = _id_ledger(spark, fact_table)
    rows = raw.where(F.col("batch_id").isin(*pending))
    if choose == "watermark":
        rows = new_raw_rows(rows, fact)
        if not rows.where(F.col("processed_at") >= clean.timestamp_literal(load_ts)).isEmpty():
            raise ValueError("by watermark, the load must be later than the run that stored the rows")
    new = written(to_fact(rows, load_ts, created_at_source, keep=["batch_id"]), f"{folder}/new")
    if cut_off := [b for b in pending if b in started]:
        present = fact.select("transaction_id").join(
            new.where(F.col("batch_id").isin(*cut_off)).select("transaction_id").distinct(), "transaction_id", "left_semi"
        )
        own = ids.of_batches(cut_off).select(F.col("key").alias("transaction_id"), "batch_id")
        done = present.join(own, "transaction_id").distinct()
        new = written(new.join(done, ["transaction_id", "batch_id"], "left_anti"), f"{folder}/left")
    known = ids.known(_keys(new), without=pending)
    first, *rest = integrity.offending_keys(new.drop("batch_id"), dim_users, dim_date).items()
    middle = [] if known is None else [("transaction_id already loaded", known.select(F.col("key").alias("transaction_id")).distinct())]
    offending = _write_keys(spark, dict([first, *middle, *rest]), f"{folder}/keys")
    flagged = integrity.flag_violations(new, offending)
    if on_violation == "fail":
        counts = {r["violation"]: r["row_count"] for r in integrity.violation_counts(flagged).collect()}
        if counts:
            raise integrity.IntegrityError(f"nothing loaded into {fact_table}: {counts}")
    elif quarantine_table:
        violating = written(integrity.violating(flagged), f"{folder}/violating")
        for batch in pending:  # as a rule one: the run that just ended
            _write_quarantine(violating.where(F.col("batch_id") == batch), quarantine_table, batch)
    passing = integrity.passing(flagged)
    held.require()
    _note(records, pending, STARTED, load_ts)
    ids.add(_keys(passing))
    n = tables.append(passing.drop("batch_id"), fact_table, cluster_by="date_id", checked=True)
    _note(records, pending, LOADED, load_ts, n)
    return n


def run_all(
    spark: SparkSession,
    input_path: str | list[str],
    raw_table: str,
    fact_table: str,
    dim_users: DataFrame,
    dim_date: DataFrame,
    run_ts: datetime,
    load_ts: datetime | None = None,
    on_violation: str = "fail",
    created_at_source: str = "load",
    **ingest_options,
) -> int:
    """Ingest, gate, load; an error in one step keeps the later ones from running. Returns how many rows were loaded.

    The gate's verdict is on the whole raw table; it reads the new batch and the ids that may meet its own. Runs of one
    raw table exclude each other. A run that was lost between two steps is made up for by the next one: a batch stored by
    half is undone, and an input that was stored already is not stored again under another batch.
    """
    wanted = ingest_options.pop("batch_id", None) or clean.batch_name(run_ts)
    quarantine = ingest_options.get("quarantine_table") or f"{raw_table}_quarantine"
    with claims.claim(spark, f"{location(spark, raw_table)}_run_claims"):
        journal, source = runs.Journal(spark, raw_table), runs.signature(spark, input_path, ingest_options)
        taken = set().union(*_batch_states(_batch_records(spark, fact_table)))
        if journal.recover(source, wanted, taken) is None:
            journal.begin(wanted, source, quarantine)
            ingest_raw(spark, input_path, raw_table, run_ts, batch_id=wanted, **ingest_options)
            journal.stored(wanted)
        verdicts.gate(spark, raw_table)
        n = load_fact_incremental(
            spark, raw_table, fact_table, dim_users, dim_date, load_ts or run_ts,
            created_at_source=created_at_source, on_violation=on_violation,
        )
        journal.end(journal.unfinished())
        return n
