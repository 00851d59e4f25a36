"""Partial sums and results kept by period (an hour, a day), which new rows change period by period.

A period has folders of partial sums, one per fold that touched it and merged into one when there are many, and one
folder with the result made of them. A fold writes new folders beside the old ones; whoever keeps the record of periods
points it to them afterwards, and deletes what it no longer points to once readers are done.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.session import read_folders

#: Folders of partial sums a period may have before they are merged into one.
MOST_PARTS = 8

#: By period: its folders of partial sums (``state``) and of its result (``summary``).
Kept = dict[str, dict[str, Any]]


class Periods:
    """Folders below ``path``. ``state`` and ``result`` are schemas without the period, which is a string of digits and
    dashes in the column ``period``; partial sums have a count ``n``. ``merged`` combines partial sums to one row a key,
    ``results`` makes results of combined ones."""

    def __init__(
        self, spark: SparkSession, path: str, period: str, state: str, result: str,
        merged: Callable[[DataFrame], DataFrame], results: Callable[[DataFrame], DataFrame],
    ) -> None:
        self.spark, self.path, self.period = spark, path, period
        self.schemas = {"state": state, "summary": result}
        self.merged, self.made = merged, results

    def _folder(self, kind: str, version: str, period: str) -> str:
        return f"{kind}/{version}/{self.period}={period}"

    def read(self, kind: str, versions: list[tuple[str, str]]) -> DataFrame:
        """Rows of these folders, as pairs of period and version."""
        paths = [f"{self.path}/{self._folder(kind, version, period)}" for period, version in versions]
        if not paths:
            return self.spark.createDataFrame([], f"{self.schemas[kind]}, {self.period} string")
        period = F.regexp_extract(F.col("_metadata.file_path"), f"{self.period}=([0-9-]+)", 1)
        return read_folders(self.spark, self.schemas[kind], paths).select("*", period.alias(self.period))

    def results(self, kept: Kept) -> DataFrame:
        return self.read("summary", [(p, of["summary"]) for p, of in kept.items()])

    def _states(self, parts: dict[str, list[str]]) -> DataFrame:
        return self.merged(self.read("state", [(p, v) for p, vs in parts.items() for v in vs]))

    def _write(self, rows: DataFrame, folder: str) -> None:
        """A folder per period, of few files; a period that holds much is split over tasks."""
        rows.hint("rebalance", F.col(self.period)).write.partitionBy(self.period).parquet(f"{self.path}/{folder}")

    def folders(self, period: str, of: dict[str, Any]) -> list[str]:
        """All folders of a period."""
        return [self._folder("state", v, period) for v in of["state"]] + [self._folder("summary", of["summary"], period)]

    def fold(self, kept: Kept, partial: DataFrame, afresh: Collection[str] = ()) -> tuple[Kept, list[str], dict[str, int]]:
        """Merge partial sums into their periods; those ``afresh`` forget what they had, and go if no row is left.

        Returns the periods as they are then, the folders nothing points to any more, and the rows per period touched.
        """
        version = uuid.uuid4().hex
        self._write(partial, f"state/{version}")
        stored = read_folders(self.spark, f"{self.schemas['state']}, {self.period} string", [f"{self.path}/state/{version}"])
        touched = {r[self.period]: r["n"] for r in stored.groupBy(self.period).agg(F.sum("n").alias("n")).collect()}
        left = {p: of for p, of in kept.items() if p not in afresh}
        replaced = [f for p in kept if p in afresh for f in self.folders(p, kept[p])]
        if not touched:
            return left, replaced, touched
        parts = {p: [*left.get(p, {"state": []})["state"], version] for p in touched}
        if full := [p for p, versions in parts.items() if len(versions) > MOST_PARTS]:
            one = uuid.uuid4().hex
            self._write(self._states({p: parts[p] for p in full}), f"state/{one}")
            replaced += [self._folder("state", v, p) for p in full for v in parts[p]]
            parts |= {p: [one] for p in full}
        self._write(self.made(self._states(parts)), f"summary/{version}")
        replaced += [self._folder("summary", left[p]["summary"], p) for p in touched if p in left]
        return left | {p: {"state": parts[p], "summary": version} for p in touched}, replaced, touched
