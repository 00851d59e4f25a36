"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order. Inverted lists per label and pivot bring
together the vectors that have the pivot among their first ones; pairs that share enough pivots are candidates, and
their cosine is verified in double precision. Close vectors see the pivots at almost equal distances, so they share
most of them; the index covers every vector, only the pivots are a sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import components, materialize

#: Pivots per square root of the number of vectors, and their bounds: the sample is never larger than the last.
PIVOTS_PER_ROOT, FEWEST, MOST = 4, 64, 16384
#: Largest cosine of two pivots. Inside one tight group, chance alone would decide which of several pivots is nearer.
APART = 0.8
#: Pivots that describe a vector, and those a candidate pair shares at least.
PREFIX, SHARED = 8, 2
#: Vectors of one inverted list that one task compares with as many others.
BLOCK = 1024


def _usable():
    return F.expr(
        "vec_id is not null and label is not null and embedding is not null"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
        " and exists(embedding, x -> x <> 0)"
    )


def _unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither squares nor sums then overflow or vanish
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def spread(vectors: np.ndarray) -> np.ndarray:
    """Of vectors in order those that are ``APART`` from all before them."""
    chosen = np.empty_like(vectors)
    n = 0
    for v in vectors:
        if not n or (chosen[:n] @ v).max() <= APART:
            chosen[n] = v
            n += 1
    return chosen[:n]


def describe(classes: DataFrame, dims: dict[int, np.ndarray]) -> DataFrame:
    """Add ``pivots``: positions of the nearest pivots, nearest first."""
    shared = classes.sparkSession.sparkContext.broadcast(dims)  # at most MOST vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v) for v in batch["embedding"].to_numpy(zero_copy_only=False)]
            size = np.array([len(v) for v in vectors])
            out: list = [None] * len(vectors)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                points = shared.value[int(dim)]
                for some in np.array_split(at, -(-len(at) // 2048)):
                    near = -(_unit([vectors[i] for i in some]) @ points.T)
                    k = min(PREFIX, near.shape[1])
                    first = np.argpartition(near, k - 1, axis=1)[:, :k]
                    order = np.argsort(np.take_along_axis(near, first, 1), axis=1, kind="stable")
                    for i, row in zip(some, np.take_along_axis(first, order, 1), strict=True):
                        out[i] = row.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "pivots"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{fields}, pivots array<int>")


def _compare(pivot: int, left: pd.DataFrame, right: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between two blocks of one list: per vector the number of linked vectors, and one link per connected set.

    Only pairs whose smallest shared pivot is this list's are counted, so every pair counts in exactly one list.
    """
    p, q = np.array(left["pivots"].tolist()), np.array(right["pivots"].tolist())
    count = np.zeros((len(p), len(q)), np.uint8)
    smaller = np.zeros((len(p), len(q)), bool)  # a smaller pivot is shared, too
    for a in range(p.shape[1]):
        for b in range(q.shape[1]):
            same = p[:, a, None] == q[None, :, b]
            count += same
            smaller |= same & (p[:, a] < pivot)[:, None]
    candidates = (count >= min(SHARED, p.shape[1])) & ~smaller
    linked = candidates & (_unit(left["embedding"]) @ _unit(right["embedding"]).T >= threshold)
    a, b = left["rep"].to_numpy(), right["rep"].to_numpy()
    linked &= a[:, None] != b[None, :]
    none = np.iinfo(np.int64).max
    label_a, label_b = np.where(linked.any(1), a, none), np.where(linked.any(0), b, none)
    while True:
        new_a = np.minimum(label_a, np.where(linked, label_b[None, :], none).min(1, initial=none))
        new_b = np.minimum(label_b, np.where(linked, new_a[:, None], none).min(0, initial=none))
        if (new_a == label_a).all() and (new_b == label_b).all():
            break
        label_a, label_b = new_a, new_b
    sides = [(left, linked @ right["n"].to_numpy(), label_a)]
    if left is not right:
        sides.append((right, linked.T @ left["n"].to_numpy(), label_b))
    out = [pd.DataFrame({"rep": side["rep"], "links": links, "to": to})[links > 0] for side, links, to in sides]
    return pd.concat(out)


def link(described: DataFrame, threshold: float) -> DataFrame:
    """``rep``, ``links``, ``to`` per class and block pair, from the inverted lists.

    A list is dealt to blocks by a hash, as many as its length asks for, and every pair of blocks is a task's group:
    no group exceeds two blocks, and no pair leaves its task.
    """
    lists = described.select("label", "dim", "rep", "n", "embedding", "pivots", F.explode("pivots").alias("pivot"))
    sizes = lists.groupBy("label", "dim", "pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = lists.join(sizes, ["label", "dim", "pivot"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", "blocks")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        pivot, lo, hi = int(group["pivot"].iloc[0]), group["lo"].iloc[0], group["hi"].iloc[0]
        left = group[group["own"] == lo]
        return _compare(pivot, left, left if lo == hi else group[group["own"] == hi], threshold)

    return dealt.groupBy("label", "dim", "pivot", "lo", "hi").applyInPandas(compare, "rep long, links long, to long")


def near_duplicates(embeddings: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept``, one row per input row.

    Vectors link within one label and length. Equal vectors are one class with a count, however many they are. A vector
    that is NULL, empty, zero or holds NULL or non-finite components, or has no label, links with nothing; a row without
    ``vec_id`` as well, and is kept without a component. Repeated rows are vectors of their own that share an id. Other
    columns are not read; an empty table gives an empty result.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    good = rows.where(_usable())
    classes = materialize(
        good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).withColumn("dim", F.size("embedding")),
        "classes",
    )
    dims = {}
    for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect():  # a row per length of vector
        m = min(MOST, max(FEWEST, math.ceil(PIVOTS_PER_ROOT * math.sqrt(r["n"]))))
        picked = classes.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("rep"), "rep", "label").limit(m).select("embedding").collect()
        dims[r["dim"]] = spread(_unit([p[0] for p in picked]))
    found = materialize(link(describe(classes, dims), threshold), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b")), "vector-components")
    known = classes.select("label", "embedding", "rep", "n").join(counts, "rep", "left").join(
        groups.withColumnRenamed("node", "rep"), "rep", "left"
    )
    known = known.select(
        "label", "embedding", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    linked = good.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(_usable(), F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
