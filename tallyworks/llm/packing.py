"""Best-fit-decreasing packing of documents into sequences of a fixed number of tokens.

Best fit decreasing depends on lengths alone, and a length is at most the sequence's. So the tables are packed on
the histogram of lengths: documents of one length are placed together into all bins of the tightest open capacity,
which a segment tree over remaining capacities finds in logarithmic time. A placement names a range of documents of
that length and a range of bins; documents then find their place by their rank among those of the same length.
The bins are those that one-by-one best fit decreasing would give.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import Memo, arrow_map, documents, map_in_arrow, materialize, remembered

END_ID = 1
#: Documents of one length that are ranked in one task.
RANKED_TOGETHER = 5000


class CapacityTree:
    """Segment tree over capacities 1..size: the smallest one that is open and at least a given length."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        node = self.leaves + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        node = self.leaves + length
        if self.open[node]:
            return length
        while node > 1 and not (node % 2 == 0 and self.open[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


@dataclass(frozen=True)
class Placement:
    """Documents ``rank`` to ``rank + count`` of ``length`` go to bins from ``bin`` on, ``per_bin`` each, from ``offset``."""

    length: int
    rank: int
    count: int
    bin: int
    per_bin: int
    offset: int


def plan(histogram: dict[int, int], size: int) -> list[Placement]:
    """Best fit decreasing over a histogram of lengths.

    At most two ranges of bins arise per length, and one range takes a given length once, so the plan's length is
    bounded by the sequence's size (some millions for 4096 at worst, thousands in practice), whatever the input.
    """
    tree, open_bins = CapacityTree(size), {}
    out: list[Placement] = []
    next_bin = 0

    def keep(capacity: int, first: int, count: int) -> None:
        if capacity > 0 and count > 0:
            open_bins.setdefault(capacity, []).append((first, count))
            tree.set(capacity, True)

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"a length of {length} does not fit into {size}")
        left, rank = histogram[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first, bins = size, next_bin, None
            else:
                first, bins = open_bins[capacity].pop()
            fit = capacity // length  # a bin just used is the tightest one as long as it has room
            full = left // fit if bins is None else min(bins, left // fit)
            if full:
                out.append(Placement(length, rank, full * fit, first, fit, size - capacity))
                keep(capacity - fit * length, first, full)
                rank, left = rank + full * fit, left - full * fit
            used = full
            if left and (bins is None or full < bins):
                out.append(Placement(length, rank, left, first + full, left, size - capacity))
                keep(capacity - left * length, first + full, 1)
                left, used = 0, full + 1
            if bins is None:
                next_bin += used
            else:
                keep(capacity, first + used, bins - used)
                if not open_bins[capacity]:
                    tree.set(capacity, False)
    return out


def pack(pieces: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` between 1 and ``size``.

    Rows of one length are ranked by ``order`` in groups of a hash of it, so a length that a third of all rows has is
    spread over tasks; only counts per group meet. Rows that agree in all of ``order`` may swap places.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= size rows
    placements = plan(counts, size)
    salts = -(-max(counts.values(), default=1) // RANKED_TOGETHER)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    group = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = group.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "_salt").orderBy(*order)
    ranked = salted.withColumn("_at", F.row_number().over(inside) - 1).join(starts, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_start") + F.col("_at")).drop("_start", "_at", "_salt")

    table = np.array([(p.length << 40 | p.rank, p.bin, p.per_bin, p.offset) for p in placements], np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast(table[np.argsort(table[:, 0])])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, first, per_bin, offset = shared.value.T
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            at = np.searchsorted(start, length << 40 | rank, side="right") - 1
            past = rank - (start[at] & ((1 << 40) - 1))
            columns = [batch[name] for name in names]
            columns += [pa.array(first[at] + past // per_bin[at]), pa.array(offset[at] + past % per_bin[at] * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    names = pieces.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return map_in_arrow(ranked, place, f"{fields}, sequence_id long, offset long")


#: White space of the vocabulary, and control characters that str.split takes for it, too.
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_CONTROL = re.compile("[\x1c-\x1f]")
#: A word with marks behind it, which the vocabulary takes apart; neither an ending like 's nor a special token.
_MARKED = re.compile(r"([^\W\d_]+)([!-&(-/:;=>?@\[-`{-~]+)")


#: The plain case of the same: letters of ASCII, and marks or none.
_PLAIN = re.compile(r"([A-Za-z]+)([!-&(-/:;=>?@\[-`{-~]*)")


#: Words a worker remembers, in each of two generations; of stretches half as many.
HELD = 400_000


class Encoder:
    """Ids of stretches without white space as bytes; words are encoded once, with or without marks behind them.

    Both are only remembered for a while: forgetting costs time and changes nothing. Words, which cost most, for longer.
    """

    def __init__(self, path: str, held: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words, self.stretches = Memo(self._word, held), Memo(self._stretch, held // 2)
        added = [re.escape(t.content.lower()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or r"(?!)")

    @classmethod
    def load(cls, path: str, held: int) -> Encoder:
        return remembered(("encoder", path, held), lambda: cls(path, held))

    @staticmethod
    def cut(text: str) -> list[str]:
        return [x for x in _WHITE.split(text) if x] if _CONTROL.search(text) else text.split()

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha() and word.islower():  # nothing to normalize or to take apart: merges only
            return array("I", [token.id for token in self.model.tokenize(word)]).tobytes()
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _stretch(self, stretch: str) -> bytes:
        if plain := _PLAIN.fullmatch(stretch):
            word, marks = plain.groups()
            return self.words[word.lower()] + self.words[marks] if marks else self.words[word.lower()]
        low = stretch.lower() if stretch.isascii() else stretch
        if self.added.search(low):  # the library tells '<|ENDOFTEXT|>' from the special token
            low = stretch
        marked = _MARKED.fullmatch(low)
        # A few letters turn into one with an accent of its own, which would go with the marks.
        if marked and (stretch.isascii() or unicodedata.normalize("NFC", marked[1]).lower().isalpha()):
            return self.words[marked[1]] + self.words[marked[2]]
        return self.words[low]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.stretches.__getitem__, self.cut(text)))


def pieces_of(docs: DataFrame, vocabulary_path: str, size: int = 4096, with_ids: bool = False, held: int = HELD) -> DataFrame:
    """Encode whole texts, add the end id, and cut only what is longer than ``size``: one row per piece.

    ``length`` ids from ``start`` of the document on, and their checksum (``with_ids``: the ids as well). White space
    only separates words in this vocabulary, so stretches without any are encoded by themselves, and remembered.
    """
    end = array("I", [END_ID]).tobytes()

    def rows(batch: dict[str, list]) -> dict[str, list]:
        encoder = Encoder.load(vocabulary_path, held)
        out: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids)}
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            data = encoder.encode(text) + end
            for piece, at in enumerate(range(0, len(data), 4 * size)):
                cut = data[at : at + 4 * size]
                out["doc_id"].append(doc_id)
                out["piece"].append(piece)
                out["start"].append(at // 4)
                out["length"].append(len(cut) // 4)
                out["ids_crc32"].append(zlib.crc32(cut))
                if with_ids:
                    out["ids"].append(np.frombuffer(cut, "<u4").tolist())
        return out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return arrow_map(documents(docs), rows, schema, step=1000, remembers=True)


def pack_documents(docs: DataFrame, vocabulary_path: str, size: int = 4096, with_ids: bool = False, held: int = HELD) -> DataFrame:
    """One row per piece: its document, place in it, checksum, sequence and offset there.

    A NULL or empty text is the end id alone. Repeated rows and NULL ids are documents of their own; other columns are
    not read; an empty table gives no sequences. ``vocabulary_path`` must name the file on every executor. A worker
    remembers the ids of up to about twice ``held`` words, some 200 bytes each; that changes the time only.
    """
    return pack(pieces_of(docs, vocabulary_path, size, with_ids, held), size, ["doc_id", "piece", "ids_crc32"])
