"""Ledgers of keys: which keys a table holds, by batch, looked up without reading the table.

A ledger is a table bucketed by key, with a folder per load. A load counts once its record exists, a small file that says
which batches it holds and, of every file, the bucket and the smallest and largest key. A look-up compares the new keys'
ranges with these, opens only files that may hold one of them, and moves only the new keys. When there are many loads,
they are merged into one, into a table of more buckets if the old ones have grown full; replaced files stay until the
merge after that, so that whoever reads them is not disturbed. Writers hold a claim of the table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.session import remove
from tallyworks.sinks.claims import Folder

#: Loads that may stand side by side, keys of a bucket before the number of buckets doubles, and slices a look-up tells
#: apart in the range of all keys.
MOST_LOADS, KEYS_PER_BUCKET, SLICES = 8, 4_000_000, 32
SCHEMA = "key BIGINT, batch_id STRING, n BIGINT, load STRING"


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0].rstrip("/")


class KeyLedger:
    """Keys (whole numbers) of ``table`` with their batch and number of rows; ``purpose`` tells several ledgers apart.

    With ``place``, all files of the ledger lie below that folder and ``table`` is but a name. Its bucketed tables are
    entered in the catalog again, with their folders, by a session whose catalog does not know them.
    """

    def __init__(self, spark: SparkSession, table: str, purpose: str = "keys", place: str | None = None) -> None:
        self.spark, self.base, self.place = spark, f"{table}_{purpose}", place
        self.entered: set[str] = set()  # loads the session's catalog is known to have
        self.records = Folder(spark, f"{place}/records" if place else f"{location(spark, table)}_{purpose}_records")

    def loads(self) -> dict[str, dict[str, Any]]:
        """Records of the loads that count, by load."""
        found = {}
        for name in self.records.names():
            if name.startswith("load-") and (record := self.records.read(name)) is not None:
                found[name.removeprefix("load-")] = record
        replaced = {old for r in found.values() for old in r["replaces"]}
        if self.place and not self.entered.issuperset(found):
            for buckets in {r["buckets"] for r in found.values()}:
                self.spark.sql(f"ALTER TABLE {self._table(buckets)} RECOVER PARTITIONS")
            self.entered |= set(found)
        return {load: r for load, r in found.items() if load not in replaced}

    def exists(self) -> bool:
        return any(n.startswith("load-") for n in self.records.names())

    def _table(self, buckets: int) -> str:
        name = f"{self.base}_{buckets}"
        place = f"LOCATION '{self.place}/{buckets}'" if self.place else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING parquet PARTITIONED BY (load)"
            f" CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS {place}"
        )
        return name

    def add(self, keys: DataFrame, dead: Sequence[tuple[str, str]] = (), merge: bool = True) -> str:
        """Record ``key``, ``batch_id`` and ``n``; from then on the pairs of load and batch in ``dead`` no longer count."""
        live = self.loads()
        buckets = max((r["buckets"] for r in live.values()), default=0) or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        load = self._store(keys, buckets, [], [list(d) for d in dead])
        if merge:
            self.tidy()
        return load

    def tidy(self) -> None:
        """Merge if there are many loads."""
        if len(self.loads()) > MOST_LOADS:
            self.merge()

    def load_rows(self, load: str) -> DataFrame:
        return self._rows({load: self.loads()[load]}, dead=())

    def _store(self, keys: DataFrame, buckets: int, replaces: list[str], dead: list[list[str]]) -> str:
        load, name = uuid.uuid4().hex, self._table(buckets)
        rows = keys.select("key", "batch_id", "n", F.lit(load).alias("load"))
        # not by the bare column: rows of a bucketed scan would count as dealt out already, and then be read without buckets
        rows.repartition(buckets, F.coalesce("key", F.lit(0))).write.insertInto(name)
        stored = self.spark.table(name).where(F.col("load") == load)
        per_file = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").alias("n"), F.collect_set("batch_id").alias("batches")
        ).collect()
        files = [[r["file"], int(re.search(r"_(\d+)\.c\d+", r["file"])[1]), r["lo"], r["hi"], r["n"]] for r in per_file]
        batches = sorted({b for r in per_file for b in r["batches"]})
        self.records.write(f"load-{load}", {"table": name, "buckets": buckets, "files": files, "batches": batches, "replaces": replaces, "dead": dead})
        return load

    def _rows(self, live: dict[str, dict[str, Any]], picked: dict[str, list[str]] | None = None, dead: Sequence[Sequence[str]] | None = None) -> DataFrame:
        """Rows of these loads that count; of ``picked``, only the named files of a load are opened."""
        gone = dead if dead is not None else [d for r in live.values() for d in r["dead"]]
        parts = []
        for table in sorted({r["table"] for r in live.values()}):
            mine = [load for load, r in live.items() if r["table"] == table and (picked is None or picked.get(load))]
            if not mine:
                continue
            rows = self.spark.table(table).where(F.col("load").isin(mine))
            if picked is not None:
                rows = rows.where(F.col("_metadata.file_name").isin([f for load in mine for f in picked[load]]))
            for load, batch in gone:
                if load in mine:
                    rows = rows.where(~((F.col("load") == load) & (F.col("batch_id") == batch)))
            parts.append(rows.select("key", "batch_id", "n"))
        if not parts:
            return self.spark.createDataFrame([], "key bigint, batch_id string, n bigint")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def rows(self) -> DataFrame:
        return self._rows(self.loads())

    def of_batches(self, batches: Sequence[str]) -> DataFrame:
        """Rows of some batches; loads without them are not opened."""
        live = self.loads()
        gone = [d for r in live.values() for d in r["dead"]]
        mine = {load: r for load, r in live.items() if set(r["batches"]) & set(batches)}
        return self._rows(mine, dead=gone).where(F.col("batch_id").isin(list(batches)))

    def picked_files(self, keys: DataFrame, live: dict[str, dict[str, Any]] | None = None) -> dict[str, list[str]]:
        """Files, by load, whose range meets the range of some of the keys, told apart by bucket and slice.

        A row for each bucket and slice comes back to the driver, whatever the number of keys.
        """
        live = self.loads() if live is None else live
        bounds = [f[2:4] for r in live.values() for f in r["files"] if f[2] is not None]
        if not bounds:
            return {}
        low, high = min(lo for lo, _ in bounds), max(hi for _, hi in bounds)
        width = max(1, (high - low) // SLICES)
        inside = keys.where(F.col("key").between(low, high))
        picked: dict[str, list[str]] = {}
        for buckets in sorted({r["buckets"] for r in live.values()}):
            spans: dict[int, list[tuple[int, int]]] = {}
            slice_of = F.floor((F.col("key") - F.lit(low).cast("decimal(20,0)")) / F.lit(width))
            by = inside.groupBy(bucket_of(F.col("key"), buckets).alias("b"), slice_of.alias("s")).agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
            for r in by.collect():
                spans.setdefault(r["b"], []).append((r["lo"], r["hi"]))
            for load, record in live.items():
                if record["buckets"] == buckets:
                    hit = [f for f, b, lo, hi, _ in record["files"] if lo is not None and any(a <= hi and lo <= z for a, z in spans.get(b, ()))]
                    if hit:
                        picked[load] = hit
        return picked

    def known(self, keys: DataFrame, without: Sequence[str] = ()) -> DataFrame | None:
        """Rows of the ledger for those of the keys it holds in other batches than ``without``; None if no file can hold any."""
        live = self.loads()
        others = {load: r for load, r in live.items() if set(r["batches"]) - set(without)}
        picked = self.picked_files(keys, others)
        if not picked:
            return None
        rows = self._rows(others, picked, [d for r in live.values() for d in r["dead"]])
        if without:
            rows = rows.where(~F.coalesce(F.col("batch_id").isin(list(without)), F.lit(False)))
        return rows.join(keys.select("key").distinct(), "key", "left_semi")

    def merge(self) -> None:
        """Write the loads' rows that count into one load, but leave out a load four times as large as the others together."""
        before = self.loads()
        size = {load: sum(f[4] for f in r["files"]) for load, r in before.items()}
        largest = max(size, key=size.get)
        dead = [d for r in before.values() for d in r["dead"]]
        keep = {largest} if size[largest] > 4 * (sum(size.values()) - size[largest]) and largest not in {d[0] for d in dead} else set()
        buckets = max(r["buckets"] for r in before.values())
        while sum(size.values()) > buckets * KEYS_PER_BUCKET:
            buckets, keep = 2 * buckets, set()
        mine = {load: r for load, r in before.items() if load not in keep}
        every = {n.removeprefix("load-") for n in self.records.names() if n.startswith("load-")}
        self._store(self._rows(mine, dead=dead), buckets, sorted(mine), [d for d in dead if d[0] in keep])
        self._sweep(every - set(before))

    def _sweep(self, stale: set[str]) -> None:
        """Delete loads that an earlier merge replaced."""
        for load in stale:
            record = self.records.read(f"load-{load}")
            if record is not None and self.spark.catalog.tableExists(record["table"]):
                place = location(self.spark, record["table"])
                self.spark.sql(f"ALTER TABLE {record['table']} DROP IF EXISTS PARTITION (load = '{load}')")
                remove(self.spark, f"{place}/load={load}")
            self.records.delete(f"load-{load}")


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket Spark puts a key into."""
    return F.pmod(F.hash(key), F.lit(buckets))
