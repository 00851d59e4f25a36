"""The daily summary kept by deltas: a load changes the days it touches, and only their new files are read.

What the summary holds is told by the fact's files: a record per day names those it was made of. An update lists the
folders, reads files that are new, and merges their partial sums per day, status and user into their days. So it does
not matter how often and by which job it is called, or whether a load was cut off, and late rows change their day. A
day that lost a file, since it was written anew, is made afresh of all its files.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Collection, Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.session import read_folders, remove, subfolders
from tallyworks.sinks import claims
from tallyworks.sinks.ledger import location
from tallyworks.sinks.periods import Periods

#: Files one step of an update reads at most, unless a single day has more; a record follows every step.
FILES_PER_STEP = 10_000
FACT = "user_id bigint, amount decimal(15,2), status string"
STATE = "status string, user_id bigint, n bigint, n_amounts bigint, total decimal(35,2)"
SUMMARY = "status string, transaction_count bigint, total_amount double, average_amount double, unique_users bigint"


def _merged(states: DataFrame) -> DataFrame:
    """One row per day, status and user; a hot day or status enters the shuffle by its users."""
    return states.groupBy("date_id", "status", "user_id").agg(
        F.sum("n").alias("n"), F.sum("n_amounts").alias("n_amounts"), F.sum("total").cast("decimal(35,2)").alias("total")
    )


def _summaries(merged: DataFrame) -> DataFrame:
    total = F.sum("total").cast("double")
    return merged.groupBy("date_id", "status").agg(
        F.sum("n").alias("transaction_count"), total.alias("total_amount"),
        F.try_divide(total, F.sum("n_amounts")).alias("average_amount"), F.count("user_id").alias("unique_users"),
    )


class DailySummary:
    """The kept summary of a fact table with a folder per ``date_id``."""

    def __init__(self, spark: SparkSession, fact_table: str) -> None:
        self.spark, self.home = spark, location(spark, fact_table)
        self.path = f"{self.home}_daily"
        self.records = claims.Folder(spark, f"{self.path}/records")
        self.periods = Periods(spark, self.path, "date_id", STATE, SUMMARY, _merged, _summaries)

    def record(self) -> dict[str, Any]:
        """``days`` with their folders, ``made_of`` with the name of each day's list of files, and what may be deleted."""
        return self.records.read("now") or {"days": {}, "made_of": {}, "replaced": [], "old": []}

    def summary(self, dim_date: DataFrame) -> DataFrame:
        """The daily summary as of the last update; days the dimension does not have are left out, as in the full one."""
        kept = self.periods.results(self.record()["days"]).withColumn("date_id", F.col("date_id").cast("int"))
        days = dim_date.select("date_id", F.col("full_date").alias("transaction_date"))
        return kept.join(days, "date_id").select(
            "transaction_date", "status", "transaction_count", "total_amount", "average_amount", "unique_users"
        )

    def _files(self, day: str) -> list[str]:
        folder = claims.Folder(self.spark, f"{self.home}/date_id={day}")
        return [n for n in folder.names() if not n.startswith(("_", "."))]

    def update(self, days: Iterable[int] | None = None) -> list[int]:
        """Bring the summary up to date with the fact, or some of its days; returns the days that changed.

        Listing all days takes a call per day folder, so a job that knows which it touched may name them.
        """
        with claims.claim(self.spark, f"{self.path}_claims") as held:
            now = self.record()
            names = [m[1] for f in subfolders(self.spark, self.home) if (m := re.fullmatch(r"date_id=(\d+)", f))]
            wanted = sorted({*names, *now["days"]}) if days is None else sorted({str(d) for d in days})
            changed = {}
            for day in wanted:
                files = self._files(day)
                digest = hashlib.sha256(json.dumps(files).encode()).hexdigest()
                made_of = f"files-{day}-{digest}"
                if now["made_of"].get(day) != made_of and (files or day in now["days"]):
                    changed[day] = (files, made_of)
            for gone in now["old"]:  # replaced before the last update; what that replaced may still be read
                remove(self.spark, f"{self.path}/{gone}")
            now |= {"old": now["replaced"], "replaced": []}
            for step in _steps(changed):
                now = self._step(held, now, step)
            return [int(d) for d in changed]

    def _step(self, held: claims.Claim, now: dict[str, Any], changed: dict[str, tuple[list[str], str]]) -> dict[str, Any]:
        paths, afresh = [], set()
        for day, (files, _) in changed.items():
            before = set(self.records.read(now["made_of"][day]) or ()) if day in now["made_of"] else set()
            if not before.issubset(files) or (day in now["days"] and not before):
                afresh.add(day)
                before = set()
            paths += [f"{self.home}/date_id={day}/{f}" for f in files if f not in before]
        kept, replaced, _ = self.periods.fold(now["days"], self._partial(paths), afresh)
        made_of = dict(now["made_of"])
        for day, (files, name) in changed.items():
            replaced += [f"records/{made_of.pop(day)}"] if day in made_of else []
            if files:
                self.records.write(name, files)
                made_of[day] = name
        back = {f"records/{name}" for name in made_of.values()}  # a day may return to files it had
        keep = lambda folders: [f for f in folders if f not in back]
        held.require()
        now = {"days": kept, "made_of": made_of, "replaced": keep(now["replaced"] + replaced), "old": keep(now["old"])}
        self.records.write("now", now)
        return now

    def _partial(self, paths: Collection[str]) -> DataFrame:
        """Partial sums of these files, combined before the shuffle."""
        if not paths:
            return self.spark.createDataFrame([], f"{STATE}, date_id string")
        day = F.regexp_extract(F.col("_metadata.file_path"), r"date_id=(\d+)", 1).alias("date_id")
        rows = read_folders(self.spark, FACT, list(paths)).select(day, "status", "user_id", "amount")
        return rows.groupBy("date_id", "status", "user_id").agg(
            F.count("*").alias("n"), F.count("amount").alias("n_amounts"), F.sum("amount").cast("decimal(35,2)").alias("total")
        )


def _steps(changed: dict[str, tuple[list[str], str]]) -> Iterator[dict[str, tuple[list[str], str]]]:
    """Days dealt into steps of bounded numbers of files."""
    step: dict[str, tuple[list[str], str]] = {}
    n = 0
    for day, (files, name) in changed.items():
        if step and n + len(files) > FILES_PER_STEP:
            yield step
            step, n = {}, 0
        step[day] = (files, name)
        n += len(files)
    if step:
        yield step
