"""Near-copies by n-gram Jaccard similarity: a blocked sparse matrix product with size-derived bounds.

Documents by n-grams is a sparse 0/1 matrix, and its product with its transpose holds the overlaps. Columns are
n-grams in one global order, the frequent ones last. Two documents similar enough share one of their first columns,
as many as the size allows to miss, so only those columns are multiplied to find candidates, and a pair is discarded
where its sizes and the positions of the first shared column bound its overlap below what it needs. Surviving pairs go to
blocks by one of their documents, where the full overlaps are accumulated over all columns. Nodes are classes of
equal sets, named by the set's hash, so that rows of one id with different texts are kept apart.

Components are asked for, not all pairs: first every column links its documents to the smallest one of about their
size; then only columns that still hold several components are multiplied in full. Their rows are compared inside tasks,
first by sizes and positions, then what is left by bitmaps; a column gives its pairs only while they are few for its rows,
else its rows. Rows left in the end are compared by full overlaps, and of the links found in a block those are given
that connect as much as all of them. So no step gives more than a few rows for each of a block; the rows of a column of
several blocks stand in as many groups each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import Memo, arrow_map, components, documents, map_in_arrow, materialize

#: Columns are compared in blocks of BLOCK rows (BLOCK_NGRAMS n-grams where sets move). A block gives pairs while a row has no
#: more of them than in a column of LONG rows, (LONG - 1) / 2 on the average, else the rows that have a pair.
LONG, BLOCK, BLOCK_NGRAMS = 5, 2048, 500_000

#: Pairs compared at a time, and words of their bitmaps.
PAIRS, PAIR_WORDS = 1 << 18, 1 << 20

#: Columns that go with a row, so that most pairs with several shared columns are seen in the first of them only.
FIRST = 8

#: N-grams whose frequency is used for the order, at most; it decides only how fast candidates are found.
FREQUENT = 200_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


class Shingler:
    """Distinct n-grams of words as sorted 64-bit hashes."""

    def __init__(self, words: int) -> None:
        self.words, self.memo = words, Memo(_word_hash, 150_000)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()  # bytes: only A-Z change, only space and \\t to \\r separate
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        width = min(self.words, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            mixed = (mixed ^ hashes[i : len(words) - width + 1 + i]) * _A
            mixed ^= mixed >> np.uint64(32)
        mixed = mixed * _B
        return np.unique(mixed ^ (mixed >> np.uint64(29)))


def sketch(shingles: np.ndarray) -> bytes:
    """Parity bitmap of a set: a bit flips with every n-gram that falls on it.

    Two sets differ in at least as many n-grams as their bitmaps in bits. The length, a power of two, follows the
    size; halves of a longer one fold into a shorter one.
    """
    bits = 1 << min(16, max(8, (3 * len(shingles)).bit_length()))
    counts = np.bincount((shingles >> np.uint64(40)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(data: bytes, size: int) -> np.ndarray:
    words = np.frombuffer(data, np.uint64)
    while len(words) > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _stacked(data: list[bytes], size: int) -> np.ndarray:
    return np.array([_folded(x, size) for x in data])


def differ_little(left: list[bytes], n: np.ndarray, right: list[bytes], m: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs (rows by columns) may be similar enough, by sizes and bitmaps; never false for one that is."""
    size = min(map(len, [*left, *right])) // 8
    a, b = _stacked(left, size), _stacked(right, size)
    total = n[:, None] + m[None, :]
    allowed = total - 2 * (-(-percent * total // (100 + percent)))
    out = np.zeros(total.shape, bool)
    for i in range(len(a)):
        out[i] = np.bitwise_count(a[i] ^ b).sum(1, dtype=np.int64) <= allowed[i]
    return out & (100 * np.minimum(n[:, None], m[None, :]) >= percent * np.maximum(n[:, None], m[None, :]))


def pairs_differ_little(left: list[bytes], n: np.ndarray, right: list[bytes], m: np.ndarray, percent: int) -> np.ndarray:
    """The same for pairs given one by one; those of one bitmap size are taken together."""
    out = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    total = n + m
    allowed = total - 2 * (-(-percent * total // (100 + percent)))
    sizes = np.array([min(len(x), len(y)) // 8 for x, y in zip(left, right, strict=True)], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        bits = _stacked([left[i] for i in at], size) ^ _stacked([right[i] for i in at], size)
        out[at] &= np.bitwise_count(bits).sum(1, dtype=np.int64) <= allowed[at]
    return out


def spanning_links(sets: list[np.ndarray], component: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Verified links between rows ``left`` and ``right`` that connect what all links between them connect.

    Rows of ``left`` are multiplied with the incidence matrix of ``right`` one by one; only partners that sizes and
    bitmaps allow and that are not connected yet take part. There are fewer links than components.
    """
    n, marks, node = np.array([len(s) for s in sets], np.int64), [sketch(s) for s in sets], np.unique(component, return_inverse=True)[1]
    near = differ_little([marks[i] for i in left], n[left], [marks[j] for j in right], n[right], percent)
    near &= node[left][:, None] != node[right][None, :]
    if not near.any():
        return []
    columns, codes = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.split(codes, np.cumsum(n)[:-1])
    held, links = np.zeros(len(columns), bool), []
    for i, partners in zip(left, near, strict=True):
        js = right[partners]
        js = js[node[js] != node[i]]
        if not len(js):
            continue
        held[rows[i]] = True
        overlap = np.add.reduceat(held[np.concatenate([rows[j] for j in js])], np.cumsum(n[js]) - n[js], dtype=np.int64)
        held[rows[i]] = False
        for j in js[100 * overlap >= percent * (n[i] + n[js] - overlap)]:
            if node[j] != node[i]:
                links.append((int(i), int(j)))
                node[node == node[j]] = node[i]
    return links


def _frequent(docs: DataFrame, words: int) -> np.ndarray:
    """Two rows, the most frequent n-grams in order and their frequency's logarithm; estimated from above a few per block."""

    def rows(batch: dict[str, list]) -> dict[str, list]:
        shingles = Shingler(words)
        found, n = np.unique(np.concatenate([shingles(t) for t in batch["text"]] or [np.empty(0, np.uint64)]), return_counts=True)
        often = np.flatnonzero(n >= 4)
        often = often[np.argsort(-n[often], kind="stable")[:FREQUENT]]
        return {"h": found[often].view(np.int64), "n": n[often]}

    counts = arrow_map(docs.select("text"), rows, "h long, n long", step=5000).groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).collect()  # bounded
    h, n = np.array([r["h"] for r in top], np.int64).view(np.uint64), np.array([r["n"] for r in top], np.float64)
    order = np.argsort(h)
    return np.vstack([h[order], np.log2(np.maximum(n[order], 1)).astype(np.uint64)]) if len(h) else np.zeros((2, 0), np.uint64)


def _index(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: ``version`` (of its text), ``n``, ``key`` (a hash of the whole set), ``sketch``, and ``columns``, its first ones in order."""
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, words))

    def rows(batch: dict[str, list]) -> dict[str, list]:
        shingles, (often, level) = Shingler(words), shared.value
        out: dict[str, list] = {"doc_id": batch["doc_id"], "version": batch["version"], "n": [], "key": [], "sketch": [], "columns": []}
        seen: set[int] = set()
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            s = shingles(text)
            key = _word_hash(s.tobytes()) >> 1
            out["n"].append(len(s))
            out["key"].append(key)
            if doc_id is None or not len(s) or key in seen:  # without an id no links; copies in a block need no columns of their own
                out["columns"].append([])
                out["sketch"].append(None)
                continue
            seen.add(key)
            out["sketch"].append(sketch(s))
            last = np.zeros(len(s), np.uint64)
            if len(often):
                at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                last[often[at] == s] = level[at[often[at] == s]]
            first = np.lexsort((s, last))[: len(s) - (percent * len(s) + 99) // 100 + 1]
            out["columns"].append(s[first].view(np.int64))
        return out

    return arrow_map(docs, rows, "doc_id long, version long, n int, key long, sketch binary, columns array<long>", step=2000)


def _possible(a: str, b: str, percent: int) -> str:
    """Whether sizes and positions of a column allow the overlap that two documents need, if it is the first they share."""
    sizes = f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"
    most = f"least({a}.n - {a}.pos, {b}.n - {b}.pos)"
    return f"{sizes} and {100 + percent} * cast({most} as bigint) >= {percent} * (cast({a}.n as bigint) + {b}.n)"


def pairs_of_groups(ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows ``i < j`` of one group, about ``PAIRS`` at a time; ``ends`` has the end of each row's group."""
    later = ends - np.arange(len(ends)) - 1
    before = np.concatenate([[0], np.cumsum(later)])
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
        i = np.repeat(np.arange(at, to), later[at:to])
        yield i, i + 1 + np.arange(len(i)) - np.repeat(before[at:to] - before[at], later[at:to])
        at = to


class Bitmaps:
    """Bitmaps of rows, compared pair by pair in the shorter one's size."""

    def __init__(self, marks: list[bytes]) -> None:
        self.size = np.array([len(x) // 8 for x in marks], np.int64)
        self.at, self.words = np.zeros((2, len(marks)), np.int64), {}
        for size in np.unique(self.size):
            for k, longer in enumerate((size, 2 * size)):  # in longer ones yet, near() rules out nothing
                rows = np.flatnonzero(self.size == longer)
                self.at[k, rows] = np.arange(len(rows)) + (len(self.words[size]) if k else 0)
                words = np.array([_folded(marks[r], size) for r in rows], np.uint64).reshape(len(rows), size)
                self.words[size] = np.vstack([self.words[size], words]) if k else words

    def near(self, i: np.ndarray, j: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Which pairs differ in at most ``allowed`` bits, never false where the n-grams differ in no more."""
        out, shorter = np.ones(len(i), bool), np.minimum(self.size[i], self.size[j])
        for size in np.unique(shorter):
            words = self.words[size]
            these = np.flatnonzero((shorter == size) & (np.maximum(self.size[i], self.size[j]) <= 2 * size))
            step = max(1, PAIR_WORDS // int(size))
            for part in (these[k : k + step] for k in range(0, len(these), step)):
                left, right = (words[np.where(self.size[x] == size, self.at[0, x], self.at[1, x])] for x in (i[part], j[part]))
                out[part] = np.bitwise_count(left ^ right).sum(1, dtype=np.int64) <= allowed[part]
        return out


class Earlier:
    """The first columns of rows, up to the column whose position is ``pos``."""

    def __init__(self, firsts: list[list[int]], pos: np.ndarray) -> None:
        sizes = np.array([len(x) for x in firsts], np.int64)
        self.held = np.arange(FIRST) < np.minimum(sizes, pos)[:, None]
        self.columns = np.zeros((len(firsts), FIRST), np.int64)
        self.columns[np.arange(FIRST) < sizes[:, None]] = [h for x in firsts for h in x]

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs certainly share one of them; others may share a later one."""
        out, columns, held = np.zeros(len(i), bool), self.columns[j], self.held[j]
        for k in range(FIRST):
            out |= ((self.columns[i, k][:, None] == columns) & held).any(1) & self.held[i, k]
        return out


def narrowed(
    rows: dict[str, np.ndarray], marks: list[bytes] | None, firsts: list[list[int]] | None, percent: int, long: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``i``, ``j`` and single rows that hold every pair of one column and block that may be similar enough.

    ``rows`` are in the order of ``h``, ``lo``, ``hi``. A pair is looked for where its first shared column stands: there
    the overlap is no more than what follows in either document. Where ``firsts`` show a pair to share an earlier
    column it is left to that one. Rows of one component need no comparison.
    """
    starts, ends = _borders(rows)
    group, ends = np.repeat(np.arange(len(starts)), ends - starts), np.repeat(ends, ends - starts)
    n, left, node, own = rows["n"], rows["n"] - rows["pos"], rows["component"], rows["own"]
    alone, bitmaps = rows["lo"] == rows["hi"], Bitmaps(marks) if marks is not None else None
    earlier = Earlier(firsts, rows["pos"]) if firsts is not None else None
    size, many = np.bincount(group, minlength=len(starts)), np.zeros(len(starts), np.int64)
    found, held = np.zeros(len(n), bool), []
    for i, j in pairs_of_groups(ends):
        near = (node[i] != node[j]) & (alone[i] | (own[i] != own[j]))
        i, j = i[near], j[near]
        total = n[i] + n[j]
        need = -(-percent * total // (100 + percent))
        near = (np.minimum(left[i], left[j]) >= need) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        i, j, allowed = i[near], j[near], (total - 2 * need)[near]
        if bitmaps is not None:
            near = bitmaps.near(i, j, allowed)
            i, j = i[near], j[near]
        if earlier is not None:
            first = ~earlier.shared(i, j)
            i, j = i[first], j[first]
        found[i] = found[j] = True
        many += np.bincount(group[i], minlength=len(starts))
        few = 2 * many[group[i]] <= (long - 1) * size[group[i]]
        held.append((i[few], j[few]))
    few = 2 * many <= (long - 1) * np.bincount(group[found], minlength=len(starts))
    i, j = (np.concatenate([x[k] for x in held] or [np.empty(0, np.int64)]) for k in (0, 1))
    return i[few[group[i]]], j[few[group[i]]], np.flatnonzero(found & ~few[group])


def _borders(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs equal in ``h``, ``lo``, ``hi``."""
    other = np.zeros(len(rows["h"]), bool)
    other[:1] = True
    for name in ("h", "lo", "hi"):
        other[1:] |= rows[name][1:] != rows[name][:-1]
    starts = np.flatnonzero(other)
    return starts, np.append(starts[1:], len(other))


_ROWS = ["h", "lo", "hi", "own", "key", "n", "pos", "component"]


def _narrow(rows: DataFrame, percent: int) -> DataFrame:
    """``key`` and ``other`` of pairs, and rows as they came with a NULL ``other``, by sizes and positions or, where ``rows`` have them, by bitmaps."""
    marked, most = "sketch" in rows.columns, LONG
    target = pa.schema([(x, pa.int64()) for x in (*_ROWS, "other")])

    def compared(table: pa.Table, rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        marks, firsts = (table[x].to_pylist() if marked else None for x in ("sketch", "first"))
        i, j, single = narrowed(rows, marks, firsts, percent, most)
        at = np.concatenate([i, single])
        other = pa.array(np.concatenate([rows["key"][j], rows["key"][single]]), mask=np.arange(len(at)) >= len(i))
        return pa.RecordBatch.from_arrays([*(pa.array(rows[x][at]) for x in _ROWS), other], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = None  # a block may go on in the next batch
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([begun, now]) if begun is not None else now
            arrays = {x: now[x].to_numpy() for x in _ROWS}
            cut = int(_borders(arrays)[0][-1]) if len(now) else 0
            begun = now.slice(cut)
            if cut:
                yield compared(now.slice(0, cut), {x: v[:cut] for x, v in arrays.items()})
        if begun is not None and len(begun):
            yield compared(begun, {x: begun[x].to_numpy() for x in _ROWS})

    numbers = rows.select(*(F.col(x).cast("long").alias(x) for x in _ROWS), *(["sketch", "first"] if marked else []))
    dealt = numbers.repartition("h", "lo", "hi").sortWithinPartitions("h", "lo", "hi")
    return map_in_arrow(dealt, run, ", ".join(f"{x} long" for x in (*_ROWS, "other")))


def _blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Every row once for each pair of blocks ``lo``, ``hi`` of its column that its own one is in; a hash of the key deals to them."""
    dealt = rows.withColumn("blocks", blocks.cast("int")).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", "blocks")


def _close(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps allow the overlap they need; only bitmaps move for the others."""
    side = lambda x: sketches.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    def rows(batch: dict[str, list]) -> dict[str, list]:
        n, m = np.array(batch["n_a"], np.int64), np.array(batch["n_b"], np.int64)
        keep = np.flatnonzero(pairs_differ_little(batch["sketch_a"], n, batch["sketch_b"], m, percent))
        return {"a": [batch["a"][i] for i in keep], "b": [batch["b"][i] for i in keep]}

    return arrow_map(pairs.join(side("a"), "a").join(side("b"), "b"), rows, "a long, b long")


def _links_of_rows(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links between the components of rows that share a column, at most as many as its rows.

    A column's rows are dealt to blocks by a hash, as many as rows and n-grams ask for, and every pair of blocks is a
    group of its own that multiplies its part of the matrix: a whole column never comes together, and pairs stay in tasks.
    """
    sizes = rows.groupBy("h").agg(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_NGRAMS).alias("size"))
    dealt = _blocks(rows.select("h", "key", "component").join(sizes, "h"), F.ceil("size")).drop("size")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own, key = group["own"].to_numpy(), group["key"].to_numpy()
        left, right = np.flatnonzero(own == group["lo"].iloc[0]), np.flatnonzero(own == group["hi"].iloc[0])
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            sets = [np.frombuffer(x, np.uint64) for x in group["set"]]
            found = spanning_links(sets, group["component"].to_numpy(), left, right, percent)
        return pd.DataFrame({"a": [key[i] for i, _ in found], "b": [key[j] for _, j in found]}, dtype="int64")

    return dealt.join(sets, "key").groupBy("h", "lo", "hi").applyInPandas(compare, "a long, b long")


def _verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full overlap suffices.

    Rows of the product are taken in blocks of one document ``b`` and its candidates; a document with very many of
    them is dealt to several blocks.
    """
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        held: tuple[int | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            keep = []
            a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
            for i in range(batch.num_rows):
                if held[0] != b[i]:
                    held = (b[i], shingles(batch["text_b"][i].as_py()))
                x, y = shingles(batch["text_a"][i].as_py()), held[1]
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                overlap = int((y[at] == x).sum())
                if 100 * overlap >= percent * (len(x) + len(y) - overlap):
                    keep.append(i)
            yield pa.RecordBatch.from_pydict({"a": [a[i] for i in keep], "b": [b[i] for i in keep]}, schema=target)

    target = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return map_in_arrow(both, run, "a long, b long")


def _texts(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """``key`` and ``text`` of one row of each wanted class of equal sets."""
    wanted = classes.join(keys.distinct(), "key", "left_semi").select("key", "rep.doc_id", "rep.version")
    return docs.join(wanted, ["doc_id", "version"]).dropDuplicates(["key"]).select("key", "text")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("key"))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``key`` and ``set``, the sorted n-grams as bytes."""

    def rows(batch: dict[str, list]) -> dict[str, list]:
        shingles = Shingler(words)
        return {"key": batch["key"], "set": [shingles(t).tobytes() for t in batch["text"]]}

    return arrow_map(texts, rows, "key long, set binary")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: one row per input row.

    Documents link when their sets of distinct ``words``-grams have a Jaccard similarity of ``percent`` or more. With
    fewer words the whole sequence is the one n-gram; a NULL text or one without words has none and links with nothing.
    A row without ``doc_id`` links with nothing and has no component. Rows that repeat an id belong to one document:
    whatever one of its texts links with is in its component. Other columns are not read; an empty table gives an empty
    result. Sets are compared by 64-bit hashes of n-grams.
    """
    docs = documents(docs).withColumn("version", F.xxhash64("text"))
    index = materialize(_index(docs, words, percent), "ngram-index")
    known = index.where("doc_id is not null and n > 0")
    classes = known.groupBy("key", "n").agg(F.min(F.struct("doc_id", "version")).alias("rep"))  # equal sets are one class
    classes = materialize(classes, "ngram-classes")
    texts_of_id = known.groupBy("doc_id").agg(F.min("key").alias("b"), F.max("key").alias("most")).where("b < most").select("doc_id", "b")
    same_id = known.select("doc_id", F.col("key").alias("a")).join(texts_of_id, "doc_id").where("a <> b").select("a", "b")

    entries = known.select("key", "n", F.posexplode("columns").alias("pos", "h")).dropDuplicates(["h", "key", "n"])
    often = entries.groupBy("h").agg(F.count("*").alias("rows")).where("rows > 1")
    #: Sizes within a step of this scale can still be similar.
    scaled = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / percent)))).cast("int")
    shared = entries.join(often.select("h"), "h").select("h", "n", "pos", "key", scaled.alias("size"))
    shared = materialize(shared, "ngram-columns")

    sketches = known.where("sketch is not null").groupBy("key", "n").agg(
        F.min("sketch").alias("sketch"), F.min(F.slice("columns", 1, FIRST)).alias("first")
    )
    sketches = materialize(sketches.join(shared.select("key").distinct(), "key", "left_semi"), "ngram-sketches")

    least = shared.groupBy("h", "size").agg(F.min(F.struct("n", "key", "pos")).alias("hub")).select("h", "size", "hub.*")
    near = least.unionByName(least.withColumn("size", F.col("size") + 1))
    pairs = shared.alias("x").join(near.alias("y"), ["h", "size"]).where("x.key <> y.key").where(_possible("x", "y", percent))
    pairs = pairs.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    pairs = materialize(_close(pairs, sketches, percent), "ngram-pairs")
    links = _verify(pairs, materialize(_texts(docs, classes, _ends(pairs)), "texts"), words, percent)
    links = materialize(links.unionByName(same_id), "ngram-links")

    groups = components(links, "ngram-components")
    placed = shared.join(groups.withColumnRenamed("node", "key"), "key", "left").select(
        "h", "n", "pos", "key", F.coalesce("component", "key").alias("component")
    )
    mixed = placed.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows"))
    mixed = materialize(placed.join(mixed.where("lo < hi").select("h", "rows"), "h"), "ngram-mixed")
    sized = materialize(_narrow(_blocks(mixed, F.ceil(F.col("rows") / BLOCK)), percent), "ngram-sized")
    marked = sized.where("other is null").drop("other").join(sketches.select("key", "sketch", "first"), "key")
    marked = materialize(_narrow(marked, percent), "ngram-marked")
    rest, found = (
        x.where("other is not null").select(F.greatest("key", "other").alias("a"), F.least("key", "other").alias("b")).distinct()
        for x in (sized, marked)
    )
    done = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rest = _close(rest, sketches, percent).unionByName(found).distinct().join(done, ["a", "b"], "left_anti")
    rest = materialize(rest, "ngram-pairs")
    left = materialize(marked.where("other is null").select("h", "key", "n", "component").distinct(), "ngram-left")
    texts = materialize(_texts(docs, classes, _ends(rest).unionByName(left.select("key"))), "texts")
    more = _verify(rest, texts.join(_ends(rest).distinct(), "key", "left_semi"), words, percent)
    sets = materialize(_sets(texts.join(left.select("key").distinct(), "key", "left_semi"), words), "ngram-sets")
    more = more.unionByName(_links_of_rows(left, sets, percent))

    groups = components(links.unionByName(more), "ngram-components").withColumnRenamed("node", "key")
    placed = classes.join(groups, "key", "left").select("key", "rep.doc_id", F.coalesce("component", "key").alias("component"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(least, "component").select("key", "component_id")
    ids = known.select("doc_id", "key").join(named, "key").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    rows = index.select("doc_id", F.col("n").cast("long").alias("n_shingles"))
    return rows.join(ids, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, with all their columns."""
    gone = near_duplicates(docs, words, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
