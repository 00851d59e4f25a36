"""Fingerprints of texts by winnowing, with array functions only.

Every run of ``k`` code points has a hash; of every ``WINDOW`` neighbouring hashes the smallest is kept with its place,
the rightmost of equal ones. Two texts that share a run of ``k + WINDOW - 1`` code points therefore share a mark, and the
places of the marks tell which windows chose them: the marks of a text joined from two others follow from theirs and from
the runs around the seam.

A mark is one long: the upper 32 bits of the hash, then ``LAST`` less the place, so that smaller means smaller hash, and
of equal hashes farther right. Minima over windows are built by doubling their width. Long texts are worked on in segments,
so that memory is bounded by a segment; every window belongs to one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyworks.llm.common import documents

#: Code points of a hashed run, hashes of a window (a power of two), and the shared run that always leaves a shared mark.
GRAM, WINDOW = 16, 32
REACH = GRAM + WINDOW - 1
SEGMENT = 32768
LAST = 2**31 - 1
#: Documents that one bucket of the order holds about, most buckets, and sampled rows for each border.
PER_BUCKET, MOST_BUCKETS, SAMPLES = 1000, 16384, 16


def _let(value: str, name: str, body: str) -> str:
    """Compute ``value`` once for a ``body`` that names it often."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def marks(text: str) -> str:
    """SQL of the marks of the text that the SQL ``text`` gives, in order of their places: none for an empty text, one
    for a text shorter than a run (all of it is then the run)."""
    run = f"(xxhash64(substring(b, 4 * (s + i) + 1, {4 * GRAM})) & {-(2**32)}L) | ({LAST}L - s - i)"
    runs = f"transform(sequence(0, least({SEGMENT + WINDOW - 2}, greatest(n - {GRAM}, 0) - s)), i -> {run})"
    low = runs
    for step in range(WINDOW.bit_length() - 1):  # a window that ends beyond the last run is left out below
        h = f"h{step}"
        low = _let(low, h, f"zip_with({h}, slice({h}, {1 + 2**step}, greatest(size({h}) - {2**step}, 0)), (x, y) -> least(x, y))")
    segment = f"array_distinct(slice({low}, 1, least({SEGMENT}, greatest(n - {REACH - 1}, 1) - s)))"
    every = f"array_distinct(flatten(transform(sequence(0, greatest(n - {REACH}, 0), {SEGMENT}), s -> {segment})))"
    return f"if({text} = '', cast(array() as array<bigint>), {_let(f'length({text})', 'n', _let(f'''encode({text}, 'UTF-32')''', 'b', every))})"


def _place(mark: str) -> str:
    return f"({LAST}L - ({mark} & {2**32 - 1}L))"


def until(found: str, stop: str) -> str:
    """SQL of those marks that a window of runs starting at or before ``stop`` chose.

    A mark is first chosen when it enters from the right (its hash is not greater than the one before it in the list) or
    when that one leaves on the left.
    """
    before = f"element_at({found}, i)"  # the one before place i, which counts from 0
    entered = f"shiftright(w, 32) <= shiftright({before}, 32)"
    start = f"case when i = 0 then 0L when {entered} then {_place('w')} - {WINDOW - 1} else {_place(before)} + 1 end"
    return f"filter({found}, (w, i) -> {start} <= {stop})"


def joined(own: str, own_marks: str, cut: str, other: str, other_marks: str, take: str) -> str:
    """SQL of the marks of the first ``cut`` code points of ``own`` followed by the first ``take`` of ``other``."""
    seam_from = f"greatest(c - {REACH - 1}, 0)"
    seam = f"concat(substring({own}, {seam_from} + 1, c - {seam_from}), substring({other}, 1, least({REACH - 1}, t)))"
    # without a whole window the seam has no marks, unless it is all of a short text
    inside = f"if(length(z) >= {REACH} or c + t < {REACH}, {marks('z')}, cast(array() as array<bigint>))"
    moved = lambda some, by: f"transform({some}, w -> w - {by})"
    parts = [until(own_marks, f"c - {REACH}"), moved(_let(seam, "z", inside), seam_from), moved(until(other_marks, f"t - {REACH}"), "c")]
    return _let(cut, "c", _let(take, "t", f"array_distinct(concat({', '.join(parts)}))"))  # else worked out for every mark


def likeness(a: str, b: str) -> Column:
    """Shared hashes of two lists of marks over all their hashes; 1 for two empty lists."""
    x, y = (f"array_distinct(transform({m}, w -> shiftright(w, 32)))" for m in (a, b))
    shared = _let(f"size(array_intersect({x}, {y}))", "c", f"if(size({x}) + size({y}) = 0, 1D, cast(c as double) / (size({x}) + size({y}) - c))")
    return F.expr(shared)


def as_text(found: str) -> Column:
    """Hash (8 hexadecimal digits) and place of every mark."""
    return F.expr(f"array_join(transform({found}, w -> concat(lower(lpad(hex(shiftrightunsigned(w, 32)), 8, '0')), '@', {_place('w')})), ' ')")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars`` and ``marks``, an array of ``hash`` (int) and ``pos`` (int), a row per row of ``docs``.

    A NULL text is the empty one and has no marks; NULL and repeated ids are rows like others. Other columns are not read.
    """
    own = documents(docs).withColumn("m", F.expr(marks("text")))
    entry = f"transform(m, w -> named_struct('hash', cast(shiftright(w, 32) as int), 'pos', cast({_place('w')} as int)))"
    return own.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.expr(entry).alias("marks"))


def _borders(keys: DataFrame) -> list[tuple[int, int]]:
    """Keys that divide all keys into about equal buckets, from a sample by hash of at most ``SAMPLES`` for each bucket
    (about; different keys only, so a repeated row does not fill it)."""
    rows = keys.count()
    buckets = min(MOST_BUCKETS, math.ceil(rows / PER_BUCKET))
    if buckets < 2:
        return []
    step = max(1, rows // (buckets * SAMPLES))
    some = keys.where(F.pmod(F.xxhash64("key", "h", F.lit(1)), F.lit(step)) == 0).distinct().orderBy("key", "h").collect()
    at = [len(some) * b // buckets for b in range(1, buckets)]
    return sorted({(some[i]["key"], some[i]["h"]) for i in at if i < len(some)})


def _bucket(borders: list[tuple[int, int]]) -> Column:
    """Number of borders at or below a row's key: a search by halving steps, folded over the steps."""
    if not borders:
        return F.lit(0)
    n = len(borders)
    steps = F.array(*[F.lit(2**b) for b in range(n.bit_length() - 1, -1, -1)])
    keys, hashes = F.lit([k for k, _ in borders]), F.lit([h for _, h in borders])

    def further(at: Column, step: Column) -> Column:
        to = at + step
        key, h = F.get(keys, to - 1), F.get(hashes, to - 1)
        return F.when((to <= n) & ((key < F.col("key")) | ((key == F.col("key")) & (h <= F.col("h")))), to).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def with_next(spark: SparkSession, docs: DataFrame, extra: dict[str, str]) -> DataFrame:
    """``doc_id``, ``text``, the SQL columns of ``extra``, and all but the id once more as ``next_*``: those of the next
    row by descending id, after the last the first.

    Rows are dealt to buckets by ranges of their keys; each bucket gets a copy of the row that follows its last, so every
    text moves once, and ``extra`` is computed where it has moved to. Rows of one id are ordered by a hash of the text;
    rows without id come last. Rows equal in id and text are neighbours and share a bucket.
    """
    base = documents(docs).withColumn("key", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("h", F.xxhash64("text"))
    borders = _borders(base.select("key", "h"))
    base = base.withColumn("bucket", _bucket(borders))
    tops = base.groupBy("bucket").agg(F.max(F.struct("key", "h")).alias("top")).select("bucket", "top.*").orderBy(F.desc("bucket")).collect()
    if not tops:
        tops, follows = [], []
    else:  # a bucket's last row is followed by the first of the next lower bucket, the lowest one's by the first of all
        follows = [(tops[(i + 1) % len(tops)]["key"], tops[(i + 1) % len(tops)]["h"], t["bucket"]) for i, t in enumerate(tops)]
    after = spark.createDataFrame(follows, "key long, h long, after int")
    copies = base.join(after, ["key", "h"]).dropDuplicates(["after"]).withColumn("bucket", F.col("after")).drop("after")
    all_rows = base.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))
    dealt = all_rows.repartition("bucket").withColumns({name: F.expr(e) for name, e in extra.items()})
    order = W.partitionBy("bucket").orderBy("copy", F.desc("key"), F.desc("h"))
    names = ["text", *extra]
    placed = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in names})
    return placed.where(~F.col("copy")).select("doc_id", *names, *[f"next_{c}" for c in names])


def edits(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Each text beside an edited one, whose last half is replaced by the beginning of the next document: ``doc_id``,
    ``n_chars``, ``edited``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    The next document is the one with the next smaller id, after the last the first; see ``with_next`` for NULL and
    repeated ids. A NULL text is the empty one: its fingerprint is empty, and so is its edited text, which it is like to
    degree 1. A single row is its own next. Equal texts have equal fingerprints. An empty table gives an empty result;
    other columns are not read.
    """
    both = with_next(spark, docs, {"m": marks("text")})
    half = "cast(floor(length(text) / 2) as int)"
    both = both.withColumns({"cut": F.expr(f"length(text) - {half}"), "take": F.expr(f"least({half}, length(next_text))")})
    both = both.withColumn("e", F.expr(joined("text", "m", "cut", "next_text", "next_m", "take")))
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.expr("concat(substring(text, 1, cut), substring(next_text, 1, take))").alias("edited"),
        as_text("m").alias("fingerprint"), as_text("e").alias("edited_fingerprint"), likeness("m", "e").alias("near_edited"), likeness("m", "next_m").alias("near_next"),
    )
