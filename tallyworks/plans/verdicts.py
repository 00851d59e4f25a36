"""The quality gate over a table that grows by batches: only batches that are new or were replaced are read.

What is kept: the figures of every batch, which merge, and a ledger of the table's ids, which new ids are looked up in.
Both are brought up to date before each verdict, so the verdict is that of the whole table.
"""

from __future__ import annotations

import hashlib
import urllib.parse
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators import quality
from tallyworks.schemas import RAW_TRANSACTIONS
from tallyworks.session import remove, scratch, written
from tallyworks.sinks import claims
from tallyworks.sinks.ledger import KeyLedger, location
from tallyworks.sinks.tables import stored_batches

#: Folder name of rows without a batch.
NO_BATCH = "__HIVE_DEFAULT_PARTITION__"


def batch_versions(spark: SparkSession, table: str) -> dict[str, str]:
    """Batches of a table partitioned by ``batch_id``, each with a digest of its files or its version folder: names and times.

    One listing of the table's folder; a batch that is replaced gets another digest, and one that is appended to as well
    (in a version folder, where the file system dates folders by their content, as HDFS and local ones do).
    """
    held = set(stored_batches(spark, table))
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{location(spark, table)}/batch_id=*/*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names: dict[str, list[str]] = {}
    for status in found:
        path = status.getPath()
        if not path.getName().startswith(("_", ".")):
            entry = f"{path.getName()} {status.getModificationTime()}"
            names.setdefault(path.getParent().getName().removeprefix("batch_id="), []).append(entry)
    unquote = urllib.parse.unquote
    return {unquote(b): hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest() for b, files in names.items() if unquote(b) in held}


class Verdicts:
    """The kept figures and ids of one table."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table, self.base = spark, table, location(spark, table)
        self.ids = KeyLedger(spark, table, "seen_ids")
        self.records = claims.Folder(spark, f"{self.base}_verdict_records")

    def partials(self) -> DataFrame:
        """Figures of all batches, brought up to date; one job at a time does that, others wait."""
        with claims.claim(self.spark, f"{self.base}_verdict_claims") as held:
            return self._update(held)

    def _update(self, held: claims.Claim) -> DataFrame:
        spark = self.spark
        state = self.records.read("state") or {"versions": {}, "path": None}
        now = batch_versions(spark, self.table)
        changed = sorted(b for b, v in now.items() if state["versions"].get(b) != v)
        gone = sorted(set(state["versions"]) - set(now))
        before = spark.read.schema(quality.PARTIALS).parquet(state["path"]) if state["path"] else spark.createDataFrame([], quality.PARTIALS)
        if not changed and not gone and state["path"]:
            return before
        outdated = {*changed, *gone}
        with scratch(spark, "verdict") as folder:
            kept = before.where(~F.col("batch_id").isin(list(outdated))) if outdated & set(state["versions"]) else before
            fresh = self._fresh(changed, outdated, folder)
            path = f"{self.base}_verdict_figures/{hashlib.sha256(repr(sorted(now.items())).encode()).hexdigest()}-{held.n}"
            remove(spark, path)
            figures = written(kept.unionByName(fresh).distinct().coalesce(1), path)
        held.require()
        self.records.write("state", {"versions": now, "path": path, "before": state["path"]})
        if state.get("before"):  # the one before last; the last may still be read
            remove(spark, state["before"])
        return figures

    def _fresh(self, changed: list[str], outdated: set[str], folder: str) -> DataFrame:
        """Figures of the changed batches, with the repeated ids they bring."""
        batch = F.coalesce("batch_id", F.lit(NO_BATCH))
        source = self.spark.table(self.table)
        chosen = F.col("batch_id").isin([b for b in changed if b != NO_BATCH])
        rows = source.where(chosen | F.col("batch_id").isNull() if NO_BATCH in changed else chosen)
        rows = rows.select("transaction_id", "amount", "status", batch.alias("batch_id"))
        dead = [(load, b) for load, r in self.ids.loads().items() for b in r["batches"] if b in outdated]
        if not changed:
            if dead:
                self.ids.add(self.spark.createDataFrame([], "key bigint, batch_id string, n bigint"), dead, merge=False)
            return self.spark.createDataFrame([], quality.PARTIALS)
        ids = rows.where(F.col("transaction_id").isNotNull()).groupBy(F.col("transaction_id").cast("bigint").alias("key"), "batch_id").agg(F.count("*").alias("n"))
        load = self.ids.add(ids, dead, merge=False)
        new = self.ids.load_rows(load)
        known = self.ids.known(new, without=sorted(outdated))
        held = new if known is None else new.unionByName(written(known, f"{folder}/known"))
        several = held.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
        figures = quality.batch_partials(rows).groupBy("batch_id", "kind", "value").agg(F.sum("n").alias("n"))
        if not several.isEmpty():  # as a rule there are none
            repeated = written(several, f"{folder}/repeated")
            figures = figures.unionByName(written(quality.repeated_partials(held, repeated), f"{folder}/figures"))
        self.ids.tidy()  # what it replaces can still be read
        return figures


def report(spark: SparkSession, table: str, table_name: str = RAW_TRANSACTIONS.name) -> DataFrame:
    """The quality report of a whole table, from its batches' figures."""
    return quality.merged_report(Verdicts(spark, table).partials(), table_name)


def gate(spark: SparkSession, table: str, table_name: str = RAW_TRANSACTIONS.name) -> dict[str, Any]:
    """Raise if the table is not valid; return the report otherwise."""
    return quality.gate_report(report(spark, table, table_name))
