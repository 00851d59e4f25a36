"""Clustering around centroids over a VA-file.

Every component of a vector becomes a cell of a few bits. For each centroid a table gives the least and greatest squared
distance that a component in a cell can add; their sums over a vector's cells bound its distance to the centroid. Where
one centroid's interval lies below all others the vector is placed without being read. Where intervals overlap, the
interval of the difference of two distances is looked at first (it is narrower, since a component's error enters once, by
the distance of the two centroids), and only where that leaves it open the vector is fetched. Cells and vectors are
columns of one table bucketed by row, so that a pass over the cells leaves the vectors unread, and those that are fetched
(where the intervals leave it open, or where a vector moves) meet the table without moving it.

Centroids are means, kept as exact whole sums: a round adds and takes away only the vectors that changed their centroid.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import materialize, shared_dir
from tallyworks.session import remove

#: A cell's bits, eight at most. Measured on the given vectors: 4 bits leave nine of ten open, 6 bits four, 8 bits one.
BITS = 8
#: Inner cells divide the mean plus and minus so many standard deviations; the outermost reach to the extremes.
SPREAD = 3.0
#: Components of this size and more (scaled) are left out: sums of squares would leave the range of a long.
LARGEST = 2**27
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
_MOVES = "cluster int, i int, v long"


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), -1)


def _per_task(df: DataFrame, add: Callable[[pa.RecordBatch, dict], None], schema: str) -> DataFrame:
    """``add`` folds every batch of a task into one dict of arrays, which is returned as rows (key, place, value)."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, np.ndarray] = {}
        for batch in batches:
            add(batch, state)
        for key, v in state.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(v), key, np.int32)), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], names=names
            )

    return df.mapInArrow(run, schema)


def grid(rows: DataFrame, dim: int) -> np.ndarray:
    """Borders of the cells, ``2 ** BITS + 1`` of them for each component, from the moments and extremes of all rows."""

    def add(batch: pa.RecordBatch, state: dict) -> None:
        x = _matrix(batch.column(0))
        for key, now, combine in ((0, x.min(0), np.minimum), (1, x.max(0), np.maximum), (2, x.sum(0), np.add), (3, (x.astype(float) ** 2).sum(0), np.add), (4, np.full(dim, len(x)), np.add)):
            state[key] = combine(state[key], now) if key in state else now
        for key in state:
            state[key] = state[key].astype(float)

    total = _per_task(rows.select("x"), add, "cluster int, i int, v double").groupBy("cluster", "i").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("v").alias("v"))
    got = np.zeros((5, dim))
    for r in total.collect():  # five figures for each component
        got[r["cluster"], r["i"]] = r[{0: "lo", 1: "hi"}.get(r["cluster"], "v")]
    lo, hi, s, q, n = got
    mean = s / np.maximum(n, 1)
    sd = np.sqrt(np.maximum(q / np.maximum(n, 1) - mean**2, 0))
    inner = np.ceil(mean + np.linspace(-SPREAD, SPREAD, 2**BITS - 1)[:, None] * sd).astype(np.int64)
    low, high = lo.astype(np.int64), hi.astype(np.int64) + 1
    return np.vstack([low, np.clip(inner, low, high), high]).T  # cell c: borders[c] <= x < borders[c + 1]


def cells_of(x: np.ndarray, borders: np.ndarray) -> np.ndarray:
    cells = np.empty(x.shape, np.uint8)
    for j in range(x.shape[1]):
        cells[:, j] = np.searchsorted(borders[j, 1:-1], x[:, j], side="right")
    return cells


def _cells(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


class Bounds:
    """Distance intervals between cells and the given centroids."""

    def __init__(self, borders: np.ndarray, centroids: np.ndarray) -> None:
        self.first, self.last = borders[:, :-1], borders[:, 1:] - 1  # smallest and largest whole number of a cell
        q = centroids[:, :, None]
        below, above = self.first - q, q - self.last
        self.least = np.maximum(np.maximum(below, above), 0) ** 2
        self.most = np.maximum(np.abs(below), np.abs(above)) ** 2
        self.centroids = centroids

    def possible(self, cells: np.ndarray) -> np.ndarray:
        """Which centroids can be nearest: rows by centroids, at least one in each row."""
        at = np.arange(cells.shape[1])
        least = np.stack([t[at, cells].sum(1) for t in self.least], axis=1)
        most = np.stack([t[at, cells].sum(1) for t in self.most], axis=1)
        can = least <= most.min(1, keepdims=True)
        unsure = np.flatnonzero(can.sum(1) > 1)
        best = most[unsure].argmin(1)
        first, last = self.first[at, cells[unsure]], self.last[at, cells[unsure]]
        norms = (self.centroids**2).sum(1)
        for b in np.unique(best):
            rows = best == b
            apart = self.centroids - self.centroids[b]
            ends = (first[rows] + last[rows]) @ apart.T + (last[rows] - first[rows]) @ np.abs(apart).T
            can[unsure[rows]] &= norms - norms[b] - ends <= 0  # else farther than b wherever in the cells the vector is
        return can

    def decided(self, cells: np.ndarray) -> np.ndarray:
        """The one possible centroid, -1 where several are possible."""
        can = self.possible(cells)
        return np.where(can.sum(1) == 1, can.argmax(1), -1)


def nearest(x: np.ndarray, centroids: np.ndarray, can: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid, the smaller number of equally near ones."""
    far = np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)
    if can is not None:
        far = np.where(can, far, np.iinfo(np.int64).max)
    at = far.argmin(1)
    return at, far[np.arange(len(x)), at]


class VaFile:
    """A table of ``key``, ``vec_id``, ``cells`` and ``x``, bucketed by ``key``."""

    def __init__(self, rows: DataFrame, dim: int) -> None:
        spark = rows.sparkSession
        self.spark, self.borders = spark, grid(rows, dim)
        borders = self.borders

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                packed = cells_of(_matrix(batch.column("x")), borders)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.tobytes() for p in packed], pa.binary())], names=[*batch.schema.names, "cells"])

        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"va_file_{uuid.uuid4().hex}"
        packed = rows.select("key", "vec_id", "x").mapInArrow(pack, "key long, vec_id long, x array<int>, cells binary")
        packed.repartition(buckets, "key").write.bucketBy(buckets, "key").sortBy("key").option("path", shared_dir(spark, "va-file")).saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        path = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").where("col_name = 'Location'").first()["data_type"]
        self.spark.sql(f"DROP TABLE {self.name}")
        remove(self.spark, path)

    def sums(self, centroids: np.ndarray) -> dict[tuple[int, int], int]:
        """Sum of each component (and, in the place after the last, number) of the vectors nearest to each centroid."""
        bounds = Bounds(self.borders, centroids)

        def add(batch: pa.RecordBatch, state: dict) -> None:
            x = _matrix(batch.column("x"))
            at, _ = nearest(x, centroids, bounds.possible(_cells(batch.column("cells"))))
            _gather(state, x, at, 1)

        return _collect(_per_task(self.table().select("cells", "x"), add, _MOVES))

    def changes(self, before: np.ndarray, now: np.ndarray) -> dict[tuple[int, int], int]:
        """What has to be added to ``sums(before)`` to make ``sums(now)``: only the fetched vectors are read whole."""
        old, new = Bounds(self.borders, before), Bounds(self.borders, now)

        def unsettled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = _cells(batch.column("cells"))
                a, b = old.decided(cells), new.decided(cells)
                wanted = pa.array((a != b) | (a < 0))
                yield pa.RecordBatch.from_arrays([batch.column("key").filter(wanted)], names=["key"])

        def add(batch: pa.RecordBatch, state: dict) -> None:
            x = _matrix(batch.column("x"))
            a, b = nearest(x, before)[0], nearest(x, now)[0]
            moved = a != b
            _gather(state, x[moved], a[moved], -1)
            _gather(state, x[moved], b[moved], 1)

        keys = self.table().select("key", "cells").mapInArrow(unsettled, "key long")
        return _collect(_per_task(keys.join(self.table().select("key", "x"), "key").select("x"), add, _MOVES))

    def assign(self, centroids: np.ndarray) -> DataFrame:
        """``vec_id``, ``cluster`` and ``distance``; distances are worked out for the possible centroids only."""
        bounds = Bounds(self.borders, centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                can = bounds.possible(_cells(batch.column("cells")))
                at, far = nearest(_matrix(batch.column("x")), centroids, can)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(far)], names=["vec_id", "cluster", "distance"])

        return self.table().select("vec_id", "cells", "x").mapInArrow(run, "vec_id long, cluster int, distance long")


def _gather(state: dict, x: np.ndarray, at: np.ndarray, sign: int) -> None:
    for c in np.unique(at):
        some = x[at == c]
        state[int(c)] = state.get(int(c), 0) + sign * np.append(some.sum(0), len(some))


def _collect(parts: DataFrame) -> dict[tuple[int, int], int]:
    """A number for each centroid and component."""
    total = parts.groupBy("cluster", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    return {(r["cluster"], r["i"]): int(r["v"]) for r in total.collect()}


def cluster(embeddings: DataFrame, dim: int = 64, scale: int = 1024, k: int = 8, rounds: int = 10, seed: int = 3) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``, a row per vector.

    Vectors with exactly ``dim`` components, none NULL or non-finite, are clustered (components of 2**27 and more once
    scaled leave a vector out, since results would not fit into a long); others give no row. Repeated rows are vectors
    of their own. The first centroids are the ``k`` vectors with the smallest hashes of ``seed`` and ``vec_id``; equal
    hashes (a repeated id) are ordered by the vector, and a row without id comes after all. Fewer vectors give fewer
    centroids, none an empty result. Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr("transform(embedding, c -> cast(c as double))").alias("c"))
    rows = rows.where(f"size(c) = {dim} and forall(c, v -> v is not null and not isnan(v) and abs(v) * {scale} < {LARGEST})")
    rows = materialize(
        rows.select(F.monotonically_increasing_id().alias("key"), "vec_id", F.expr(f"transform(c, v -> cast(floor(v * {scale}) as int))").alias("x")),
        "va-rows",
    )
    start = rows.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "x")
    first = [r["x"] for r in start.orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()]
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids = np.array(first, np.int64)
    file = VaFile(rows, dim)
    total: dict[tuple[int, int], int] = {}
    before = None
    for _ in range(rounds):
        for place, v in (file.sums(centroids) if before is None else file.changes(before, centroids)).items():
            total[place] = total.get(place, 0) + v
        before, centroids = centroids, centroids.copy()
        for c in range(len(centroids)):
            if n := total.get((c, dim), 0):
                centroids[c] = [total.get((c, i), 0) // n for i in range(dim)]
        if (before == centroids).all():
            break  # nothing moves any more, in this round or later
    placed = materialize(file.assign(centroids), "va-placed")
    file.drop()
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    pick = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)
    fits = lambda v: v if v < 2**63 else None
    return placed.select(
        "vec_id", "cluster", "distance", pick([fits(sums.get(c, 0)) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(fits(sum(sums.values()))).cast("long").alias("inertia"), pick(shas, "string").alias("centroid_sha256"),
    )
