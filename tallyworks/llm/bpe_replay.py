"""Byte-level BPE by merge replay over all distinct pieces at once.

The distinct pieces of a block of texts form one small corpus of symbols. An inverted index from the token that a
pair of neighbours would become to the pair's positions drives it: the lowest rank present is applied at all of its
positions, from the left, and only the touched neighbours enter the index anew. A piece is thus encoded once per
block, however often it occurs, and texts are put together from the pieces.

The corpus of a replay is the block of a task rather than the whole table: merges of different pieces do not
interact, so the ids are the same, and no row has to be shuffled to collect pieces or to give back their ids.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterable
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame

from tallyworks.llm.common import arrow_map, documents

#: A blank that splits a run of white space where the pattern would not; such texts are cut by the pattern as a whole.
_MIXED = re.compile(r"\s \s|\s $")


class Replay:
    """Encoder and decoder over a rank file."""

    #: Encoded parts held between blocks; only a cache.
    HELD = 300_000

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks, self.pieces = ranks, regex.compile(pattern)
        self.tokens = {i: b for b, i in ranks.items()}
        #: Two neighbouring tokens that together are a token: sorted keys of both ids, and that token.
        pairs = sorted(
            ((a << 32) | b, token)
            for text, token in ranks.items()
            for i in range(1, len(text))
            if (a := ranks.get(text[:i])) is not None and (b := ranks.get(text[i:])) is not None
        )
        self.keys, self.values = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        #: Part of a text: its ids as text, their number, the bytes they decode to.
        self.memo: dict[str, tuple[str, int, bytes]] = {}

    @classmethod
    @functools.lru_cache(maxsize=2)
    def load(cls, path: str, pattern: str) -> Replay:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        return cls(ranks, pattern)

    def _joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Token of each pair, -1 where it is none or a side is no live symbol."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.values[at], -1)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: merges in rank order over the symbols of all words.

        ``symbol`` holds every word between two end marks (-1); ``after`` and ``before`` link the live symbols.
        """
        if not words:
            return []
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.concatenate([[0], np.cumsum(size + 1)[:-1]]) + 1
        symbol = np.full(int(size.sum()) + len(words) + 1, -1, np.int64)
        inside = np.ones(len(symbol), bool)
        inside[0] = False
        inside[start + size] = False
        symbol[inside] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, len(symbol) + 1), np.arange(-1, len(symbol) - 1)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray, token: np.ndarray) -> None:
            at, token = at[token >= 0], token[token >= 0]
            order = np.argsort(token, kind="stable")
            at, token = at[order], token[order]
            cuts = np.flatnonzero(np.diff(token)) + 1
            for t, positions in zip(token[np.concatenate([[0], cuts])].tolist() if len(at) else (), np.split(at, cuts), strict=False):
                if t in index:
                    index[t].append(positions)
                else:
                    index[t] = [positions]
                    heappush(heap, t)

        enter(np.arange(len(symbol) - 1), self._joined(symbol[:-1], symbol[1:]))
        while heap:
            token = heappop(heap)
            found = index.pop(token)
            i = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            i = i[symbol[i] >= 0]
            j = after[i]
            fits = self._joined(symbol[i], symbol[j]) == token  # else a neighbour took one of the two
            i, j = i[fits], j[fits]
            if len(i) > 1 and (touching := np.concatenate([[False], i[1:] == j[:-1]])).any():
                run = np.arange(len(i))  # of overlapping pairs, the first, third, ... from the left are joined
                run -= np.maximum.accumulate(np.where(touching, 0, run))
                i, j = i[run % 2 == 0], j[run % 2 == 0]
            if not len(i):
                continue
            k = after[j]
            symbol[i], symbol[j] = token, -2
            after[i], before[k] = k, i
            left = before[i]
            joined = np.full(len(i), token)
            enter(np.concatenate([i, left]), np.concatenate([self._joined(joined, symbol[k]), self._joined(symbol[left], joined)]))
        live = symbol[symbol != -2]
        ends = np.flatnonzero(live == -1)
        ids = live.tolist()
        return [ids[a + 1 : b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def learn(self, parts: set[str]) -> None:
        """Encode parts not met before: cut by the pattern, replay the distinct pieces, put together again."""
        several, todo = {}, set()
        for part in parts:
            if part.isalpha() or part[0] == " " and part[1:].isalpha():
                todo.add(part)  # one piece, as the pattern would have it
            else:
                several[part] = pieces = [m.group() for m in self.pieces.finditer(part)]
                todo.update(p for p in pieces if p not in self.memo)
        words = [p.encode() for p in todo]
        whole, get, name = self.ranks.get, self.tokens.__getitem__, str
        left = [w for w in words if whole(w) is None]
        ids_of = dict(zip(left, self.replay(left), strict=True))
        for piece, word in zip(todo, words, strict=True):
            ids = ids_of.get(word) or [whole(word)]
            self.memo[piece] = (" ".join(map(name, ids)), len(ids), b"".join(map(get, ids)))
        for part, pieces in several.items():
            if len(pieces) > 1:
                texts, sizes, data = zip(*map(self.memo.__getitem__, pieces), strict=True)
                self.memo[part] = (" ".join(texts), sum(sizes), b"".join(data))

    def parts(self, text: str) -> list[str]:
        """Cut before blanks where the pattern cuts as well, so that parts can be encoded apart."""
        if _MIXED.search(text):
            return [m.group() for m in self.pieces.finditer(text)]
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + x for x in rest]

    def prepare(self, texts: list[str]) -> None:
        """Learn the parts of a block of texts in one replay."""
        if len(self.memo) > self.HELD:
            self.memo = {}
        wanted: set[str] = set()
        for text in texts:
            wanted.update(self.parts(text))
        self.learn(wanted - self.memo.keys())

    def encode(self, text: str) -> list[tuple[str, int, bytes]]:
        """The parts of a prepared text: ids as text, their number, the decoded bytes."""
        return list(map(self.memo.__getitem__, self.parts(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of a sequence of ids."""
        return b"".join(map(self.tokens.__getitem__, ids))


def encode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode it again, and return both as digests (``ids``: the ids as well).

    Without special tokens: their strings are ordinary text. A NULL text is the empty one and has no tokens; repeated
    rows and NULL ids stay rows of their own; other columns are not read; an empty table gives an empty result.
    ``ranks_path`` must name the rank file on every executor.
    """

    def rows(batch: dict[str, list]) -> dict[str, list]:
        coder = Replay.load(ranks_path, pattern)
        out: dict[str, list] = {"doc_id": batch["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        ids_of = out.setdefault("ids", []) if with_ids else None
        coder.prepare(batch["text"])
        for parts in map(coder.encode, batch["text"]):
            ids = " ".join([p[0] for p in parts if p[1]])
            out["n_tokens"].append(sum([p[1] for p in parts]))
            out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(b"".join([p[2] for p in parts])).hexdigest())
            if ids_of is not None:
                ids_of.append([int(i) for i in ids.split()])
        return out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return arrow_map(documents(docs), rows, schema, step=10_000)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``data``, the bytes of its ``ids``."""

    def rows(batch: dict[str, list]) -> dict[str, list]:
        coder = Replay.load(ranks_path, pattern)
        return {"doc_id": batch["doc_id"], "data": [coder.decode(ids or ()) for ids in batch["ids"]]}

    return arrow_map(encoded.select("doc_id", "ids"), rows, "doc_id long, data binary")
