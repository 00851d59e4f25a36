"""Removal of byte strings that an earlier document holds, by suffix arrays over the places that can repeat.

A string of ``length`` bytes is looked at through its anchor, the leftmost of its 16-byte grams with the smallest
hash: equal strings have the anchor at the same place. Anchors are dealt by hash. Where all that surrounds an anchor
is equal, the first document is the origin and all others repeat it. Where the surroundings differ, their bytes are
fetched and a suffix array over them tells, through common prefixes, which strings around the anchor are equal.

The suffix array is built by linear grouping. Groups of suffixes with one Lyndon prefix are processed in descending
order; every suffix points to the previous smaller one, and how many of a group point to a suffix moves it to its own
group. Then the suffixes are emitted in order, each one placing those that point over it, without any renaming.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import documents, map_in_arrow, materialize

GRAM = 16
#: Bytes of text hashed at a time; positions in it fit into the low bits of a gram's rank.
SEGMENT, LOW = 1 << 17, np.uint64((1 << 20) - 1)
#: Text bytes whose anchors one bucket holds, about, and those that a task takes at a time.
BUCKET_BYTES, TAKEN = 4 << 20, 2 << 20

_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of symbols of which the last is smaller than all others, by linear grouping."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * (n + 1)
    start, last = 0, None
    for at, i in enumerate(order):  # groups are stretches of order, named by where they start
        if text[i] != last:
            start, last = at, text[i]
        place[i], group[i] = at, start
        size[start] += 1
    previous = [-1] * n
    end = n
    while end > 0:  # from the largest group down
        start = group[order[end - 1]]
        found: dict[int, int] = {}
        for i in sorted(order[start:end]) if end - start > 1 else (order[start],):
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                found[p] = found.get(p, 0) + 1
        end = start
        if not found:
            continue
        if len(found) == 1:
            levels = [list(found)]
        else:
            by_count: dict[int, list[int]] = {}
            for p, c in found.items():
                by_count.setdefault(c, []).append(p)
            levels = [by_count[c] for c in sorted(by_count, reverse=True)]
        for members in levels:  # those with more followers come to lie further behind
            for p in members:
                g = group[p]
                size[g] -= 1
                a, b = place[p], g + size[g]
                q = order[b]
                order[a], order[b] = q, p
                place[q], place[p] = a, b
            for p in members:
                group[p] += size[group[p]]
            for p in members:
                size[group[p]] += 1
    out = [-1] * n
    out[0] = n - 1
    free = list(range(n))
    placed = [False] * n
    placed[n - 1] = True
    for at in range(n):
        i = out[at] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            placed[i] = True
            i = previous[i]
    return out


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2 to the 64."""
    size = 1 << 19
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Anchors of texts laid end to end, at most a segment of them or a single longer part.

    ``text``: which text; ``at``: its position in ``data``; ``lo``, ``hi``: first and last start of the strings it
    stands for; ``gram``: its hash; ``around``: hash of all bytes that those strings may have.
    """
    n = len(data)
    starts = np.concatenate([[0], ends[:-1]])
    up, down = _powers()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1]) if n >= GRAM else np.empty(0, np.uint64)
    rank = (grams & ~LOW) | np.arange(len(grams), dtype=np.uint64)
    width, span = length - GRAM + 1, 1
    while 2 * span <= width:
        rank = np.minimum(rank[:-span], rank[span:]) if len(rank) > span else rank[:0]
        span *= 2
    if width > span:
        rank = np.minimum(rank[: span - width], rank[width - span :]) if len(rank) > width - span else rank[:0]
    count = np.maximum(ends - starts - length + 1, 0)
    text = np.repeat(np.arange(len(ends)), count)
    lo = np.repeat(starts - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(text))
    least = rank[lo]
    first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])])) if len(lo) else lo
    last = np.concatenate([first[1:], [len(lo)]])[: len(first)] - 1
    at = (least[first] & LOW).astype(np.int64)
    text, lo, hi = text[first], lo[first], lo[last]
    left, right = np.maximum(at - (length - GRAM), starts[text]), np.minimum(at + length, ends[text])
    around = _mixed((sums[right] - sums[left]) * down[left])
    around = _mixed(around ^ ((at - left).astype(np.uint64) << np.uint64(32)) ^ (right - at).astype(np.uint64))
    return {"text": text, "at": at, "lo": lo, "hi": hi, "gram": grams[at], "around": around}


def _segments(sizes: list[int], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Texts, or overlapping parts of longer ones, as (text, from, to), put together to segments."""
    held, total = [], 0
    for text, size in enumerate(sizes):
        for begin in range(0, max(1, size - length + 1), SEGMENT):
            end = min(size, begin + SEGMENT + length - 1)
            if total + end - begin > 2 * SEGMENT - length and held:
                yield held
                held, total = [], 0
            held.append((text, begin, end))
            total += end - begin
    if held:
        yield held


Ranges = tuple[list[int], list[int], list[bytes]]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before, the first row included."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return fresh


def _merged(doc: np.ndarray, version: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Ranges:
    """Per document and text its byte ranges as packed pairs, sorted and joined where they touch."""
    if not len(doc):
        return [], [], []
    order = np.lexsort((lo, version, doc))
    doc, version, lo, hi = doc[order], version[order], lo[order], hi[order]
    fresh = _changes(doc, version)
    part = np.cumsum(fresh) - 1
    reach = np.maximum.accumulate(hi + part * (1 << 40)) - part * (1 << 40)
    begin = fresh | np.concatenate([[True], lo[1:] > reach[:-1]])
    at = np.flatnonzero(begin)
    pairs = np.stack([lo[at], reach[np.concatenate([at[1:], [len(doc)]]) - 1]], 1).astype("<i8")
    cuts = np.flatnonzero(fresh[at])
    return doc[at[cuts]].tolist(), version[at[cuts]].tolist(), [pairs[a:b].tobytes() for a, b in pairwise([*cuts.tolist(), len(at)])]


#: ``version`` tells texts of one id apart; a place in a text fits into 31 bits, as a text does.
_ROW = np.dtype([("gram", "<u8"), ("around", "<u8"), ("doc", "<i8"), ("version", "<i8"), ("at", "<i4"), ("lo", "<u2"), ("hi", "<u2")])


def _origins(rows: np.ndarray, length: int) -> tuple[np.ndarray, Ranges]:
    """Of equal surroundings the rows of the first document, sorted by gram; the ranges of those that repeat them."""
    rows = rows[np.lexsort((rows["doc"], rows["around"], rows["gram"]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows["gram"][1:] != rows["gram"][:-1]) | (rows["around"][1:] != rows["around"][:-1])
    origin = rows["doc"][np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(rows) else rows["doc"]
    again = rows["doc"] > origin
    copies = rows[again]
    at = copies["at"].astype(np.int64)
    ranges = _merged(copies["doc"], copies["version"], at - copies["lo"], at - copies["hi"] + length)
    return rows[~again], ranges


def _doc_ranges(decided: Ranges) -> pa.RecordBatch:
    """Ranges on their way past the comparison: in negative buckets, many of them."""
    return pa.RecordBatch.from_arrays(
        [pa.array([-1 - d % 1024 for d in decided[0]], pa.int64()), *(pa.array(x, pa.int64()) for x in decided[:2]), pa.array(decided[2], pa.binary())],
        names=["bucket", "doc_id", "version", "data"],
    )


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by portions of about ``TAKEN`` bytes of text, so that a task's memory does not follow the batch size."""
    for batch in batches:
        upto = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + TAKEN)))
            yield batch.slice(at, stop - at)
            at = stop


def version_bytes(ids: DataFrame) -> int:
    """How many bytes of the hash ``version`` tell all texts of one ``doc_id`` apart: none if no id has several texts.

    An id's smallest and largest hash are compared per value of these bytes, which Spark combines before it moves them.
    """
    for size in (0, 1, 2, 3, 4, 6):
        kept = F.col("version").bitwiseAND(F.lit((1 << 8 * size) - 1).cast("long"))
        texts = ids.groupBy("doc_id", kept.alias("kept")).agg(F.min("version").alias("first"), F.max("version").alias("last"))
        if texts.where("first < last").isEmpty():
            return size
    return 8


def _find(docs: DataFrame, length: int, buckets: int, mark: int) -> DataFrame:
    """Per portion and bucket the anchors as packed rows; ranges already known to repeat go with their document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            ids, versions = batch["doc_id"].to_numpy(), batch["version"].to_numpy()
            texts = [t.encode() for t in batch["text"].to_pylist()]
            parts = []
            for segment in _segments([len(t) for t in texts], length):
                data = np.frombuffer(b"".join([texts[t][a:b] for t, a, b in segment]), np.uint8)
                ends = np.cumsum([b - a for _, a, b in segment])
                found = anchors(data, ends, length)
                inner = found["text"]
                shift = np.array([a for _, a, _ in segment]) - np.concatenate([[0], ends[:-1]])
                rows = np.empty(len(inner), _ROW)
                rows["gram"], rows["around"] = found["gram"], found["around"]
                owner = np.array([t for t, _, _ in segment])[inner]
                rows["doc"], rows["version"] = ids[owner], versions[owner]
                rows["at"] = found["at"] + shift[inner]
                rows["lo"], rows["hi"] = found["at"] - found["lo"], found["at"] - found["hi"]
                parts.append(rows)
            if not parts:
                continue
            rows, ranges = _origins(np.concatenate(parts), length)
            yield _doc_ranges(ranges)
            bucket = (rows["gram"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            cuts = np.flatnonzero(_changes(bucket)).tolist() if len(rows) else []
            none = pa.array([None] * len(cuts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts], pa.int64()), none, none, pa.array([_packed(rows[x:y], mark) for x, y in pairwise([*cuts, len(rows)])] if cuts else [], pa.binary())],
                names=["bucket", "doc_id", "version", "data"],
            )

    return map_in_arrow(docs, run, "bucket long, doc_id long, version long, data binary")


def _planes(column: np.ndarray, size: int) -> bytes:
    """The lowest ``size`` bytes of whole numbers: first bytes of all, then second ones. Most of them compress well."""
    return column.view(np.uint8).reshape(len(column), column.itemsize).T[:size].tobytes()


def _packed(rows: np.ndarray, mark: int) -> bytes:
    """Columns one after the other in the order of the texts, the first text's number first; versions have ``mark`` bytes.

    48 bits of each hash are kept. Grams that agree in them by chance are told apart by their bytes later on.
    """
    rows = rows[np.lexsort((rows["at"], rows["version"], rows["doc"]))]
    columns = {name: np.ascontiguousarray(rows[name]) for name in _ROW.names} | {"doc": np.diff(rows["doc"], prepend=0)}
    return _squeeze(np.int64(len(rows)).tobytes() + b"".join(_planes(columns[name], size) for name, size in _kept_bytes(mark)))


def _kept_bytes(mark: int) -> list[tuple[str, int]]:
    return [("gram", 6), ("around", 6), ("doc", 8), ("version", mark), ("at", 4), ("lo", 2), ("hi", 2)]


def _unpacked(data: bytes, mark: int) -> np.ndarray:
    data = np.frombuffer(_loosen(data), np.uint8)
    n, at = int(data[:8].view("<i8")[0]), 8
    rows = np.zeros(n, _ROW)
    for name, size in _kept_bytes(mark):
        whole = np.zeros((n, _ROW[name].itemsize), np.uint8)
        whole[:, :size] = data[at : at + n * size].reshape(size, n).T
        rows[name] = whole.view(_ROW[name]).ravel()
        at += n * size
    rows["doc"] = np.cumsum(rows["doc"])
    return rows


def _squeeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _loosen(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _squeezed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` as compressed bytes, for a shuffle of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = pa.array([_squeeze(t.encode()) for t in batch["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([data if n == "text" else batch[n] for n in batch.schema.names], names=batch.schema.names)

    fields = ", ".join(f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema)
    return map_in_arrow(docs, run, fields)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The blobs of each bucket of a partition that is sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for bucket, data in zip(batch["bucket"].to_pylist(), batch["data"].to_pylist(), strict=True):
            if bucket != now and held:
                yield now, held
                held = []
            now = bucket
            held.append(data)
    if held:
        yield now, held


_ASK = np.dtype([("gram", "<u8"), ("at", "<i4"), ("lo", "<u2"), ("hi", "<u2")])


def _compare(found: DataFrame, length: int, mark: int) -> DataFrame:
    """Per bucket: ranges that repeat an equal surrounding (``asked`` false), and the anchors whose surroundings differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def anchors_only() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                decided = pc.less(batch["bucket"], 0)
                past = batch.filter(decided)
                past = [past["doc_id"], past["version"], pa.array([False] * past.num_rows, pa.bool_()), past["data"]]
                passing.append(pa.RecordBatch.from_arrays(past, names=names))
                yield batch.filter(pc.invert(decided))

        passing: list[pa.RecordBatch] = []
        names = ["doc_id", "version", "asked", "data"]
        for _, blobs in _by_bucket(anchors_only()):
            yield from passing
            passing.clear()
            rows, ranges = _origins(np.concatenate([_unpacked(b, mark) for b in blobs]), length)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in ranges[:2]), pa.array([False] * len(ranges[0]), pa.bool_()), pa.array(ranges[2], pa.binary())], names=names,
            )
            if not len(rows):
                continue
            fresh = np.concatenate([[True], rows["gram"][1:] != rows["gram"][:-1]])
            start = np.flatnonzero(fresh)
            low, high = np.minimum.reduceat(rows["doc"], start), np.maximum.reduceat(rows["doc"], start)
            rows = rows[(low < high)[np.cumsum(fresh) - 1]]  # several documents, each with surroundings of its own
            rows = rows[np.lexsort((rows["version"], rows["doc"]))]
            doc, version = rows["doc"], rows["version"]
            cuts = np.flatnonzero(_changes(doc, version)).tolist() if len(doc) else []
            asks = np.empty(len(rows), _ASK)
            for name in _ASK.names:
                asks[name] = rows[name]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[cuts], pa.int64()), pa.array(version[cuts], pa.int64()), pa.array([True] * len(cuts), pa.bool_()),
                 pa.array([asks[a:b].tobytes() for a, b in pairwise([*cuts, len(doc)])] if cuts else [], pa.binary())],
                names=names,
            )
        yield from passing

    return map_in_arrow(found, run, "doc_id long, version long, asked boolean, data binary")


def _surroundings(length: int) -> np.dtype:
    side = length - GRAM
    return np.dtype([
        ("gram", "<u8"), ("doc", "<i8"), ("version", "<i8"), ("at", "<i4"), ("lo", "<u2"), ("hi", "<u2"), ("left", "<u2"), ("right", "<u2"),
        ("bytes", "u1", (side + length,)),
    ])


def _fetch(docs: DataFrame, asked: DataFrame, length: int, buckets: int) -> DataFrame:
    """The bytes around the anchors asked for, per bucket."""
    side, kind = length - GRAM, _surroundings(length)
    rows = asked.groupBy("doc_id", "version").agg(F.collect_list("data").alias("asks"))  # a text's own anchors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            parts = []
            for doc, version, text, asks in zip(*(batch[c].to_pylist() for c in ("doc_id", "version", "text", "asks")), strict=True):
                ask = np.frombuffer(b"".join(asks), _ASK)
                data = np.frombuffer(bytes(side) + _loosen(text) + bytes(length), np.uint8)
                ask = ask[ask["at"] + GRAM <= len(data) - side - length]
                out = np.empty(len(ask), kind)
                for name in _ASK.names:
                    out[name] = ask[name]
                out["doc"], out["version"] = doc, version
                out["left"] = np.minimum(ask["at"], side)
                out["right"] = np.minimum(len(data) - side - length - ask["at"], length)
                out["bytes"] = data[ask["at"][:, None] + np.arange(side + length)]
                parts.append(out)
            if parts:
                out = np.concatenate(parts)
                bucket = (out["gram"] // np.uint64(buckets) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                out, bucket = out[order], bucket[order]
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist() if len(out) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts], pa.int64()),
                     pa.array([_squeeze(out[a:b].tobytes()) for a, b in pairwise([*cuts, len(out)])] if cuts else [], pa.binary())],
                    names=["bucket", "data"],
                )

    return map_in_arrow(_squeezed(docs).join(rows, ["doc_id", "version"]), run, "bucket long, data binary")


def repeated(rows: np.ndarray, length: int) -> np.ndarray:
    """For each surrounding (row) and each offset of a string's start left of the anchor: is it in an earlier document?"""
    side = length - GRAM
    right = np.ascontiguousarray(rows["bytes"][:, side:])
    # Symbols are stretches of up to 17 bytes, ranked; a text of symbols per surrounding, ended by the smallest.
    cuts = [0, *range(GRAM, length, 17), length]
    symbols = np.zeros((len(rows), len(cuts)), np.int64)
    for k, (a, b) in enumerate(pairwise(cuts)):
        piece = np.zeros((len(rows), 17), np.uint8)
        piece[:, : b - a] = right[:, a:b]
        symbols[:, k] = np.unique(piece.view("V17").ravel(), return_inverse=True)[1]
    symbols[:, :-1] += 2
    symbols[:, -1] = 1
    order = np.array(suffix_array([*symbols.ravel().tolist(), 0]), np.int64)
    order = order[order % len(cuts) == 0] // len(cuts)
    order = order[order < len(rows)]
    rows, right = rows[order], right[order]
    differ = right[1:] != right[:-1]
    common = np.where(differ.any(1), differ.argmax(1), length)
    left = rows["bytes"][:, :side][:, ::-1].astype(np.uint64) + np.uint64(1)
    before = np.zeros(len(rows), np.uint64)
    hit = np.zeros((len(rows), side + 1), bool)
    for x in range(side + 1):
        if x:
            before = _mixed((before ^ left[:, x - 1]) * np.uint64(_BASE))
        interval = np.concatenate([[0], np.cumsum(common < length - x)])
        own = np.flatnonzero((rows["hi"] <= x) & (x <= rows["lo"]))
        if len(own) < 2:
            continue
        sort = own[np.lexsort((rows["doc"][own], before[own], interval[own]))]
        fresh = np.ones(len(sort), bool)
        fresh[1:] = (interval[sort][1:] != interval[sort][:-1]) | (before[sort][1:] != before[sort][:-1])
        origin = rows["doc"][sort][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        hit[sort, x] = rows["doc"][sort] > origin
    out = np.empty_like(hit)
    out[order] = hit
    return out


def _sort(fetched: DataFrame, length: int) -> DataFrame:
    kind = _surroundings(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_bucket(batches):
            rows = np.frombuffer(b"".join(map(_loosen, blobs)), kind)
            hit, x = np.nonzero(repeated(rows, length))
            begin = rows["at"][hit] - x
            docs, versions, ranges = _merged(rows["doc"][hit], rows["version"][hit], begin, begin + length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(versions, pa.int64()), pa.array(ranges, pa.binary())], names=["doc_id", "version", "data"]
            )

    return map_in_arrow(fetched, run, "doc_id long, version long, data binary")


def _cut(rows: DataFrame, carried: list[str]) -> DataFrame:
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            out: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for text, parts in zip(batch["text"].to_pylist(), batch["parts"].to_pylist(), strict=True):
                data = _loosen(text)
                pairs = np.frombuffer(b"".join(parts or ()), "<i8").reshape(-1, 2)
                one = np.zeros(len(pairs), np.int64)
                *_, ranges = _merged(one, one, pairs[:, 0], pairs[:, 1])
                spans = np.frombuffer(b"".join(ranges), "<i8").reshape(-1, 2).tolist()
                edges = [0, *(x for span in spans for x in span), len(data)]
                kept = b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(kept))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept)
            made = [pa.array(v, pa.string() if k == "kept_sha256" else pa.binary() if k == "kept" else pa.int64()) for k, v in out.items()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", *carried)), *made], names=["doc_id", *carried, *out])

    fields = "".join(f"`{name}` {rows.schema[name].dataType.simpleString()}, " for name in carried)
    return map_in_arrow(rows, run, f"doc_id long, {fields}n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, length: int = 50, carry: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (the remaining bytes).

    Every byte that a string of ``length`` bytes covers which also starts in a document of a smaller ``doc_id`` goes;
    strings are judged on the input. A NULL text is the empty one. A row without ``doc_id`` loses nothing and repeats
    nothing. Rows that repeat an id are not earlier than each other, and each is cut by its own text's ranges: texts of
    one id are told apart by a 64-bit hash, of which only as many bytes are moved as differ. Other columns are not read, but for those that ``carry`` takes along under new names; an
    empty table gives an empty result.
    """
    if length < GRAM:
        raise ValueError(f"strings shorter than {GRAM} bytes have no anchor")
    carry = carry or {}
    ids = documents(docs).where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("version"), F.octet_length("text").alias("size"))
    ids = materialize(ids, "text-versions")
    mark, total = version_bytes(ids), ids.agg(F.sum("size")).first()[0] or 0
    version = F.xxhash64("text") if mark == 8 else F.xxhash64("text").bitwiseAND(F.lit((1 << 8 * mark) - 1).cast("long"))
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *[c.alias(n) for n, c in carry.items()]
    ).withColumn("version", version)
    known = documents(docs).withColumn("version", version).where("doc_id is not null")
    buckets = max(16, -(-total // BUCKET_BYTES))
    found = _find(known, length, buckets, mark).repartition("bucket").sortWithinPartitions("bucket")
    compared = materialize(_compare(found, length, mark), "compared")
    fetched = _fetch(known, compared.where("asked"), length, buckets).repartition("bucket").sortWithinPartitions("bucket")
    ranges = compared.where("not asked").select("doc_id", "version", "data").unionByName(_sort(fetched, length))
    ranges = ranges.groupBy("doc_id", "version").agg(F.collect_list("data").alias("parts"))  # ranges within one text
    return _cut(_squeezed(whole).join(ranges, ["doc_id", "version"], "left"), list(carry))


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` with repeated byte strings removed from ``text``; halves of cut characters go as well.

    Texts that repeat nothing stay as they are, NULL among them; all rows and columns are kept.
    """
    names = {c: f"_{i}" for i, c in enumerate(docs.columns) if c != "text"}  # the text moves once, compressed
    cut = remove_repeats(docs, length, {n: F.col(c) for c, n in names.items()} | {"_null": F.col("text").isNull()})

    def readable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.decode(errors="ignore") for x in batch["kept"].to_pylist()]
            yield batch.append_column("_text", pa.array(texts, pa.string()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    cut = map_in_arrow(cut, readable, f"{fields}, _text string")
    out = {"text": F.when(~F.col("_null"), F.col("_text"))}
    if "n_chars" in names:
        count = F.length("_text").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col("n_removed") > 0, count).otherwise(F.col(names["n_chars"]))
    return cut.select(*[out[c].alias(c) if c in out else F.col(names[c]).alias(c) for c in docs.columns])
