"""What several operators need: reading only their own columns, a bounded memo, Arrow batches, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.session import configure, materialize, shared_dir

__all__ = [
    "Memo", "arrow_map", "components", "documents", "forget", "map_in_arrow", "materialize", "release", "remembered", "shared_dir", "table",
]

_REMEMBERED: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read through Spark only."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` with a NULL text as the empty one, so that no other column can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


class Memo(dict):
    """``memo[key]`` computes ``make(key)`` once and holds the latest results in two generations.

    Only a cache: forgetting changes no result. At most ``2 * size`` entries are held, whatever the input.
    """

    def __init__(self, make: Callable, size: int = 200_000) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def remembered(key: tuple, make: Callable):
    """What a worker keeps from task to task: the latest such thing only, for workers pass from operator to operator."""
    if key not in _REMEMBERED:
        forget()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def forget() -> None:
    if _REMEMBERED:
        _REMEMBERED.clear()
        gc.collect()  # a thing and its memos refer to each other, so it would stay until Python looks for such circles
        release()


def release() -> None:
    """Give memory that is free back to the system: workers, idle ones too, stay for tasks of other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim is not None:
        trim(0)


#: Bytes of rows, about, that go to a worker at a time. Spark's 64 MB hold all of a task's texts, which then stand in the
#: JVM (twice while its buffers grow) and in the worker at once, for every task that runs.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session sends workers ``BATCH_BYTES`` at a time, unless somebody chose a limit. Frames are run later, so it stays set."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY, None) is None:
        conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return df


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` of an operator that remembers nothing: drops what an earlier one left, and leaves no free memory."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        yield from run(batches)
        release()

    return in_small_batches(df).mapInArrow(whole, schema)


def arrow_map(
    df: DataFrame, rows: Callable[[dict[str, list]], dict[str, list]], schema: str, step: int = 1000, remembers: bool = False
) -> DataFrame:
    """Apply ``rows`` to column lists of at most ``step`` rows; both sides are dicts of columns.

    Unless ``rows`` asks for something ``remembered``, what an earlier operator left in the worker is dropped.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not remembers:
            forget()
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                out = rows(batch.slice(at, step).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)
                del out
                release()

    return in_small_batches(df).mapInArrow(run, schema)


def components(edges: DataFrame, purpose: str = "links") -> DataFrame:
    """``node``, ``component``: the smallest node reachable over ``edges`` (``a``, ``b``; long, not NULL).

    Alternates the two star contractions: every node's larger neighbours, then its smaller ones, are linked to the
    smallest node it sees. Each half is one aggregate and one join, so a node with very many links sends only
    partial minima and is split by the skewed join. Rounds grow with the logarithm of the longest path. Every
    round is written to the shared folder, which cuts the lineage and survives lost executors.
    """
    now = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), purpose
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("x"), "u", "m")
        pairs = small.select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        now = materialize(pairs.where("u <> v").distinct(), purpose)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
