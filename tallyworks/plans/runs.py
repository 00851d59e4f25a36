"""What a whole run is about to do, written down before it does it, so that the next run can finish or undo it.

A run leaves a record when it begins to store a batch, one when raw rows and quarantine are both stored, and none once
the batch is loaded. A run that finds the record of a lost one undoes a batch stored by half. A batch that was stored
is not stored again when its input comes again; gate and load take it, as they take any batch that is not loaded. What a
load was about to do to ledger and fact is in the load's own records.
"""

from __future__ import annotations

import hashlib
import json
import logging
import urllib.parse
from collections.abc import Collection, Mapping
from typing import Any

from pyspark.sql import SparkSession

from tallyworks.sinks import claims, tables
from tallyworks.sinks.ledger import location

logger = logging.getLogger(__name__)

BEGUN, STORED = "begun", "stored"


def signature(spark: SparkSession, input_path: str | list[str], options: Mapping[str, Any]) -> str:
    """Tells inputs apart: by the names, sizes and times of the files, and by how they are to be read."""
    files = []
    for path in [input_path] if isinstance(input_path, str) else input_path:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(target) or []:
            listed = system.listFiles(found.getPath(), True)
            while listed.hasNext():
                file = listed.next()
                files.append([file.getPath().toString(), file.getLen(), file.getModificationTime()])
    text = json.dumps([sorted(files), sorted((k, repr(v)) for k, v in options.items())])
    return hashlib.sha256(text.encode()).hexdigest()


class Journal:
    """Records of the runs of one raw table that are not complete; whoever changes them holds a claim of the table."""

    def __init__(self, spark: SparkSession, raw_table: str) -> None:
        self.spark, self.table = spark, raw_table
        self.records = claims.Folder(spark, f"{location(spark, raw_table)}_runs")

    @staticmethod
    def _name(batch_id: str) -> str:
        return f"run-{urllib.parse.quote(batch_id, safe='')}"

    def unfinished(self) -> dict[str, dict[str, Any]]:
        """Records by batch."""
        found = {}
        for name in self.records.names():
            if name.startswith("run-") and (record := self.records.read(name)) is not None:
                found[urllib.parse.unquote(name.removeprefix("run-"))] = record
        return found

    def begin(self, batch_id: str, input_signature: str, quarantine_table: str) -> None:
        self.records.write(self._name(batch_id), {"state": BEGUN, "input": input_signature, "quarantine": quarantine_table})

    def stored(self, batch_id: str) -> None:
        self.records.write(self._name(batch_id), self.records.read(self._name(batch_id)) | {"state": STORED})

    def end(self, batches: Collection[str]) -> None:
        for batch in batches:
            self.records.delete(self._name(batch))

    def recover(self, input_signature: str, batch_id: str, taken: Collection[str]) -> str | None:
        """Undo batches stored by half, except ``batch_id``, which is about to be stored anew, and those that a load has
        ``taken`` meanwhile. Returns the batch that holds the given input already, if any."""
        held = None
        present = set(tables.stored_batches(self.spark, self.table))
        for batch, record in self.unfinished().items():
            if record["state"] == STORED and record["input"] == input_signature and batch in present:
                held = batch
            elif record["state"] == BEGUN and batch != batch_id and batch not in taken:
                logger.warning("batch %s of %s was stored by half and is undone", batch, self.table)
                tables.drop_batch(self.spark, self.table, batch)
                if self.spark.catalog.tableExists(record["quarantine"]):
                    tables.drop_batch(self.spark, record["quarantine"], batch)
                self.end([batch])
        return held
