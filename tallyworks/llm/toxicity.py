"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their beginnings: all that the examples hold, none is left out. A term weighs by its document
frequency over every document and by how differently the two labels use it; a term that no example holds tells
nothing and weighs 0. Texts are read twice, for the frequencies and for the scores, and no counts are stored; terms are
hashed for many texts at once, a word's beginnings on the way to the whole word.
The examples are a bounded sample of labelled rows (``EXAMPLES``); their index goes to all tasks.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import arrow_map, documents, map_in_arrow, materialize, release

#: Labelled rows to learn from at most, per label (0, 1), those first in the order of a hash of their id.
EXAMPLES = {0: 1000, 1: 1000}
PREFIXES = (4, 5, 6, 7, 8)
NEIGHBOURS, PRIOR_WEIGHT = 15, 0.25
BLOCK = 64
#: A term of more than one in so many examples is kept as a dense row of its weights, others as postings.
DENSE = 8
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")


#: Different words hashed at once, and code points of a word that are compared at once; longer words are finished apart.
TOGETHER, WIDTH = 100_000, 32


def _step(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    h = (h ^ points) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _hash_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and of their beginnings, and which word each belongs to."""
    points = np.array(words, f"U{WIDTH}").view(np.uint32).reshape(len(words), WIDTH).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words))
    h = np.full(len(words), 0x51ED270B, np.uint64)
    terms, owners = [], []
    for n in range(min(WIDTH, int(length.max(initial=0)))):
        going = np.flatnonzero(length > n)
        h[going] = _step(h[going], points[going, n])
        if n + 1 in PREFIXES:
            longer = going[length[going] > n + 1]
            terms.append(_step(h[longer], np.uint64(1)))  # a beginning is another term than the word of the same letters
            owners.append(longer)
    for i in np.flatnonzero(length > WIDTH):
        rest = h[i : i + 1]
        for letter in words[i][WIDTH:]:
            rest = _step(rest, np.uint64(ord(letter)))
        h[i] = rest[0]
    return np.concatenate([*terms, _step(h, np.uint64(2))]), np.concatenate([*owners, np.arange(len(words))])


class _Numbers(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def count_terms(texts: Sequence[str], vocabulary: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count), ordered by text and term; terms are hashes, or positions in ``vocabulary`` of those it holds.

    Every different word is hashed once for all texts it occurs in, as long as there are no more than ``TOGETHER``.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    place = _Numbers()
    docs: list[int] = []
    uses: list[np.ndarray] = []

    def flush() -> None:
        if not place:
            return
        words = np.concatenate(uses)
        doc = np.repeat(np.asarray(docs, np.int64), [len(u) for u in uses])
        doc, words, n = _combined(doc, words, len(place))
        terms, of = _hash_words(list(place))
        if vocabulary is None:
            names, terms = np.unique(terms, return_inverse=True)
        else:
            names = vocabulary
            order = np.argsort(terms)  # neighbours are looked up in the same stretch of the vocabulary
            terms, of = terms[order], of[order]
            at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
            known = vocabulary[at] == terms
            terms, of = at[known], of[known]
        order = np.argsort(of, kind="stable")
        terms, edges = terms[order], np.searchsorted(of[order], np.arange(len(place) + 1))
        first, many = edges[words], edges[words + 1] - edges[words]  # terms of the word of each use
        which = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        doc, terms, n = _combined(np.repeat(doc, many), terms[which], len(names), np.repeat(n, many))
        parts.append((doc, names[terms] if vocabulary is None else terms, n))
        place.clear(), docs.clear(), uses.clear()

    for i, text in enumerate(texts):
        found = _WORD.findall(text.lower())
        for k in range(0, len(found), TOGETHER):
            docs.append(i)
            uses.append(np.fromiter(map(place.__getitem__, found[k : k + TOGETHER]), np.int64))
            if len(place) >= TOGETHER:
                flush()
    flush()
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.uint64 if vocabulary is None else np.int64), np.empty(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    doc, terms, n = (np.concatenate(p) for p in zip(*parts, strict=True))  # a text may be in two parts
    names, terms = np.unique(terms, return_inverse=True)
    doc, terms, n = _combined(doc, terms, len(names), n)
    return doc, names[terms], n


def _combined(doc: np.ndarray, terms: np.ndarray, size: int, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a text and a term below ``size``, in order, with the sum of their counts (1 each if not given)."""
    if not len(doc):
        return doc, terms, np.empty(0, np.int64)
    pairs = doc * size + terms
    if n is None:
        pairs.sort()
    else:
        order = np.argsort(pairs)
        pairs, n = pairs[order], n[order]
    starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    total = np.diff(np.r_[starts, len(pairs)]) if n is None else np.add.reduceat(n, starts)
    return pairs[starts] // size, pairs[starts] % size, total


def _split(n: int, doc: np.ndarray, *values: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """The values of each of ``n`` texts."""
    edges = np.searchsorted(doc, np.arange(n + 1))
    return [tuple(v[a:b] for v in values) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def choose_examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``toxic``, ``text`` of a bounded sample without near copies.

    Copies would tie all of a text's words to its label. A row goes if an earlier id shares one of its six minimal
    three-word windows.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic in (0, 1)"
    ).where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for label, most in EXAMPLES.items()
    ]
    sample = documents(docs).join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")  # at most sum(EXAMPLES) ids
    sample = materialize(sample.dropDuplicates(["doc_id"]), "examples")

    def sketch(batch: dict[str, list]) -> dict[str, list]:
        import xxhash

        ids, sketches = [], []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            words = text.split()
            windows = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in windows], np.uint64)
            for k in range(6):
                mixed = hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * k) ^ (hashes >> np.uint64(29 + k))
                ids.append(doc_id)
                sketches.append(int(mixed.min() >> np.uint64(1)) ^ k)
        return {"doc_id": ids, "sketch": sketches}

    sketches = arrow_map(sample.select("doc_id", "text"), sketch, "doc_id long, sketch long")
    copies = sketches.join(sketches.groupBy("sketch").agg(F.min("doc_id").alias("first")), "sketch").where("doc_id > first")
    return sample.join(copies.select("doc_id").distinct(), "doc_id", "left_anti")


def example_terms(sample: DataFrame) -> list:
    """Per example ``doc_id``, ``toxic``, and all its terms (64-bit hashes) and counts as bytes; at most sum(EXAMPLES) rows."""

    def rows(batch: dict[str, list]) -> dict[str, list]:
        counted = _split(len(batch["text"]), *count_terms(batch["text"]))
        return {
            "doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": [t.astype(np.uint64).tobytes() for t, _ in counted],
            "counts": [n.astype(np.int32).tobytes() for _, n in counted],
        }

    found = arrow_map(sample.select("doc_id", "toxic", "text"), rows, "doc_id long, toxic int, terms binary, counts binary")
    return sorted(found.collect(), key=lambda r: r["doc_id"])


#: Texts whose terms are counted at once.
TEXTS = 400


def document_frequency(docs: DataFrame, vocabulary: np.ndarray, shared) -> tuple[np.ndarray, int]:
    """In how many documents each term of the vocabulary (``shared`` with the tasks) occurs, and how many there are."""
    schema = pa.schema([("t", pa.int32()), ("n", pa.int64())])
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for k in range(0, batch.num_rows, TEXTS):
                _, terms, _ = count_terms(batch["text"].slice(k, TEXTS).to_pylist(), shared.value)
                seen += np.bincount(terms.astype(np.int64), minlength=size)  # once for each text, however often it names the term
                del terms
                release()
        at = np.append(np.flatnonzero(seen), size)
        n = np.append(seen[at[:-1]], rows)
        for k in range(0, len(at), 100_000):
            part = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(at[part], pa.int32()), pa.array(n[part], pa.int64())], schema=schema)

    counted = map_in_arrow(documents(docs).select("text"), run, "t int, n long")
    sums = counted.groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # <= size + 1 rows
    out = np.zeros(size + 1, np.int64)
    out[sums["t"].to_numpy()] = sums["n"].to_numpy()
    return out[:-1], int(out[-1])


def tell(n0: np.ndarray, n1: np.ndarray, examples0: int, examples1: int) -> np.ndarray:
    """How differently the labels use a term: its log odds in toxic against clean examples, without sign.

    Half a use more for toxic examples, and as many for clean ones as fit their number, so that an unused term has 0.
    """
    more0, more1 = 0.5 * examples0 / examples1, 0.5
    return np.abs(np.log((n1 + more1) / (examples1 + 2 * more1)) - np.log((n0 + more0) / (examples0 + 2 * more0)))


class BlockMaxIndex:
    """Examples in blocks of ``BLOCK`` consecutive ones: postings per term, and dense rows with each block's largest weight for frequent terms."""

    def __init__(self, ids: list[int], labels: list[int], vectors: Iterable) -> None:
        """``vectors``: terms and weights per example, as a dict or as a pair of arrays."""
        pairs = [(np.fromiter(v, np.int32), np.fromiter(v.values(), float)) if isinstance(v, dict) else v for v in vectors]
        self.ids, self.labels = np.array(ids, np.int64), np.array(labels, np.int64)
        self.blocks = -(-len(ids) // BLOCK)
        terms = np.concatenate([t for t, _ in pairs] or [np.empty(0, np.int32)])
        at = np.repeat(np.arange(len(pairs), dtype=np.int32), [len(t) for t, _ in pairs])
        weight = np.concatenate([w for _, w in pairs] or [np.empty(0)])
        del pairs
        size = int(terms.max(initial=-1)) + 1
        lengths = np.bincount(terms, minlength=size)
        frequent = np.flatnonzero(lengths * DENSE > len(ids))
        self.row = np.full(size, -1, np.int32)
        self.row[frequent] = np.arange(len(frequent))
        heavy = self.row[terms] >= 0
        self.dense_parts = self.row[terms[heavy]], at[heavy], weight[heavy]
        terms, at, weight = terms[~heavy], at[~heavy], weight[~heavy]
        order = np.argsort(terms, kind="stable")
        self.at, self.weight = at[order], weight[order]
        self.start = np.searchsorted(terms[order], np.arange(size + 1))

    @functools.cached_property
    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of frequent terms by examples, and the largest one of each block; made where it is used."""
        term, at, weight = self.dense_parts
        out = np.zeros((int((self.row >= 0).sum()), self.blocks * BLOCK))
        out[term, at] = weight
        return out, out.reshape(len(out), self.blocks, BLOCK).max(2)

    def nearest(self, query: dict[int, float], k: int) -> list[tuple[float, int]]:
        """The ``k`` examples of the largest positive cosine, ties by id: (cosine, position)."""
        return self.nearest_of([(np.fromiter(query, np.int64), np.fromiter(query.values(), float))], k)[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """The same for several queries (terms, weights).

        Postings give each example a part of its cosine. With the dense rows' block maxima they bound a block from above;
        only blocks that can still reach the ``k``-th best part are opened, for all queries that need them at once.
        """
        if not self.blocks:
            return [[] for _ in queries]
        dense, highest = self.dense
        scores, heavy = np.zeros((len(queries), self.blocks * BLOCK)), np.zeros((len(queries), len(dense)))
        for i, (terms, weights) in enumerate(queries):
            known = terms < len(self.row)
            terms, weights = terms[known], weights[known]
            row = self.row[terms]
            heavy[i, row[row >= 0]] = weights[row >= 0]
            terms, weights = terms[row < 0], weights[row < 0]
            n = self.start[terms + 1] - self.start[terms]
            if total := int(n.sum()):
                which = np.repeat(self.start[terms] - np.cumsum(n) + n, n) + np.arange(total)
                scores[i] = np.bincount(self.at[which], self.weight[which] * np.repeat(weights, n), scores.shape[1])
        kth = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.zeros(len(queries))
        bound = scores.reshape(len(queries), self.blocks, BLOCK).max(2) + heavy @ highest
        open_ = bound > np.maximum(kth - 1e-8, 0)[:, None]  # rounding must not close a block
        for block in np.flatnonzero(open_.any(0)).tolist():
            need, part = np.flatnonzero(open_[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
            scores[need, part] += heavy[need] @ dense[:, part]
        out = []
        for s in scores.round(9):
            best = np.flatnonzero(s >= (np.partition(s, -k)[-k] if len(s) > k else 0))
            best = best[s[best] > 0]
            out.append([(float(s[i]), int(i)) for i in best[np.lexsort((best, -s[best]))[:k]]])
        return out


def _unit(terms: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    vector = (1 + np.log(counts)) * weight[terms]
    some = vector > 0
    return terms[some], vector[some] / np.sqrt((vector[some] ** 2).sum() or 1.0)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``evidence`` (the nearest examples) for every whole text.

    The score is the distance-weighted share of toxic neighbours, every neighbour weighted by how many labelled rows its
    class has per example, and drawn towards the rate of toxic rows among the labelled ones, which is also the score of
    a text without known terms (a NULL or empty text among them). A NULL id is not held out; repeated rows get one row
    each; other columns are not read. Without labels of both kinds the score is the rate of the one there is (0 without
    any). An empty table gives an empty result. Terms are equal where their 64-bit hashes are.
    """
    return _verdicts(_scored(docs, labels)).drop("h", "size")


def _texts(docs: DataFrame) -> DataFrame:
    return documents(docs).select("doc_id", "text", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))


def _scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, hash and size of the text, ``score`` and ``evidence``."""
    context = docs.sparkSession.sparkContext
    sample = materialize(choose_examples(docs, labels), "examples")
    examples = example_terms(sample)
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.agg(F.count("*").alias("n")).where("toxic in (0, 1)").collect()}  # two rows
    sizes = Counter(e["toxic"] for e in examples)
    class_weight = {y: totals.get(y, 0) / sizes[y] if sizes[y] else 0.0 for y in (0, 1)}
    mass = {y: totals.get(y, 0) if sizes[y] else 0 for y in (0, 1)}
    prior = mass[1] / (sum(mass.values()) or 1)

    both = bool(sizes[0] and sizes[1])
    terms = [np.frombuffer(e["terms"], np.uint64) for e in examples] if both else []
    vocabulary = np.unique(np.concatenate(terms or [np.empty(0, np.uint64)]))
    if not len(vocabulary):
        nobody = F.expr(f"cast(array() as {_EVIDENCE})").alias("evidence")
        return _texts(docs).select("doc_id", "h", "size", F.lit(float(prior)).alias("score"), nobody)
    ids, marks, counts = ([e[c] for e in examples] for c in ("doc_id", "toxic", "counts"))
    terms = [np.searchsorted(vocabulary, t).astype(np.int32) for t in terms]
    del examples  # the driver holds millions of terms
    used = np.zeros((2, len(vocabulary)), np.int64)
    for t, y in zip(terms, marks, strict=True):
        used[y, t] += 1
    words = context.broadcast(vocabulary)
    frequency, n_docs = document_frequency(docs, vocabulary, words)
    weight = (np.log((1 + n_docs) / (1 + frequency)) + 1) * tell(used[0], used[1], sizes[0], sizes[1])
    index = BlockMaxIndex(ids, marks, (_unit(t, np.frombuffer(n, np.int32), weight) for t, n in zip(terms, counts, strict=True)))
    del terms, counts
    shared = context.broadcast((index, weight))

    def rows(batch: dict[str, list]) -> dict[str, list]:
        index, weight = shared.value
        out: dict[str, list] = {"doc_id": batch["doc_id"], "h": batch["h"], "size": batch["size"], "score": [], "evidence": []}
        place = {text: i for i, text in enumerate(dict.fromkeys(batch["text"]))}
        counted = _split(len(place), *count_terms(list(place), words.value))
        nearest = index.nearest_of([_unit(t.astype(np.int64), n, weight) for t, n in counted], NEIGHBOURS)
        for near in (nearest[place[text]] for text in batch["text"]):
            votes = [(s * class_weight[int(index.labels[i])], int(index.labels[i])) for s, i in near]
            pull = PRIOR_WEIGHT * min(class_weight.values())
            mass = sum(v for v, _ in votes) + pull
            out["score"].append(float((sum(v for v, y in votes if y) + pull * prior) / mass if near and mass else prior))
            out["evidence"].append([{"doc_id": int(index.ids[i]), "cosine": s, "toxic": int(index.labels[i])} for s, i in near])
        return out

    return arrow_map(_texts(docs), rows, f"doc_id long, h long, size int, score double, evidence {_EVIDENCE}", step=TEXTS)


_EVIDENCE = "array<struct<doc_id: bigint, cosine: double, toxic: int>>"


def _verdicts(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id", "h", "size", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence",
    )


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, with all their columns.

    Texts are judged, not ids: rows that share an id, or have none, stay or go by their own texts. Texts are told apart
    by their size and a 64-bit hash, so that only these are moved.
    """
    toxic = _verdicts(_scored(docs, labels)).where("predicted = 1").select(F.col("h").alias("_toxic_h"), F.col("size").alias("_toxic_size")).distinct()
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.join(toxic, (F.xxhash64(text) == toxic["_toxic_h"]) & (F.octet_length(text) == toxic["_toxic_size"]), "left_anti")
