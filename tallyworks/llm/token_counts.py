"""Token counts with a transducer compiled from a word-level BPE vocabulary.

Inside a stretch without white space a small automaton over character classes finds the words; each of its closing
transitions emits the number of tokens of the word that ends there. White space brings it back to the one start
state, so a whole stretch is a single transition from the start state to itself, which is compiled when the stretch
is first met and carries the sum of the counts it emits. Counting a text is then one table look-up per stretch.

A text is cut into chunks anywhere, even inside a word. Each chunk has a state map: what it emits between its first
and last white space, and the two open ends. Maps compose associatively, so a scan over them counts any length.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyworks.llm.common import Memo, documents

CHUNK = 1 << 16
#: Words of more bytes are merged through a heap; shorter ones are faster with plain lists. Counts are the same.
LONG_WORD = 64

#: Fixed values of the vocabulary's own definition: its white space, and the endings that form words of their own.
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Control characters that str.split takes for white space and the vocabulary does not.
_CONTROL = re.compile("[\x1c-\x1f]")

START, LETTERS, OTHERS = range(3)


@functools.lru_cache(maxsize=65536)
def _class(char: str) -> str:
    return unicodedata.category(char)[0]


def _byte_characters() -> list[str]:
    """Characters that stand for the 256 bytes: printable ones for themselves, the rest from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Transducer:
    """Compiled transitions over stretches without white space."""

    def __init__(self, ranks: dict[tuple[str, str], int], suffix: str, vocabulary: set[str], special: list[str]) -> None:
        self.ranks, self.suffix, self.vocabulary = ranks, suffix, vocabulary
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.bytes = _byte_characters()
        self.word = Memo(self._emitted)
        self.step = Memo(self._compile)

    @classmethod
    @functools.lru_cache(maxsize=2)
    def load(cls, path: str) -> Transducer:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        return cls(
            {tuple(p): rank for rank, p in enumerate(pairs)}, model["end_of_word_suffix"] or "", set(model["vocab"]),
            [t["content"] for t in spec["added_tokens"]],
        )

    def _emitted(self, word: str) -> int:
        """Tokens on the transition that closes ``word``."""
        parts = [self.bytes[b] for b in word.encode()]
        parts[-1] += self.suffix
        if len(parts) > LONG_WORD:
            return self._emitted_long(parts)
        rank, none = self.ranks.get, len(self.ranks)
        pairs = [rank(p, none) for p in zip(parts, parts[1:], strict=False)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(pairs):
                pairs[i] = rank((parts[i], parts[i + 1]), none)
        return sum(p in self.vocabulary for p in parts)

    def _emitted_long(self, parts: list[str]) -> int:
        """The same over linked parts, with the open pairs in a heap by rank and place: n log n for n bytes."""
        rank, none, n = self.ranks.get, len(self.ranks), len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]), none)) < none]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j == n or rank((parts[i], parts[j]), none) != r:
                continue  # one of the two was merged since
            parts[i], parts[j] = parts[i] + parts[j], ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank((parts[a], parts[b]), none)) < none:
                    heapq.heappush(heap, (r, a))
        return sum(p in self.vocabulary for p in parts if p)

    def words(self, stretch: str) -> list[str]:
        """Run the class automaton over a stretch in normal form; a word ends where a transition closes it."""
        out, state, begin, i = [], START, 0, 0
        if stretch.isascii() and stretch[:-1].isalpha():  # all letters but one: no need to look at each
            return [stretch[:-1], stretch[-1]]
        while i < len(stretch):
            kind = _class(stretch[i])
            if state == LETTERS and kind != "L" or state == OTHERS and kind in "LN":
                out.append(stretch[begin:i])
                state = START
            if state == START:
                begin = i
                if stretch[i] == "'" and (ending := next((e for e in _ENDINGS if stretch.startswith(e, i)), None)):
                    out.append(ending)
                    i += len(ending)
                    continue
                if kind == "N":
                    out.append(stretch[i])
                else:
                    state = LETTERS if kind == "L" else OTHERS
            i += 1
        if state != START:
            out.append(stretch[begin:])
        return out

    def _compile(self, stretch: str) -> int:
        if self.special and (hit := self.special.search(stretch)):
            left, right = stretch[: hit.start()], stretch[hit.end() :]
            return (self._compile(left) if left else 0) + 1 + (self._compile(right) if right else 0)
        plain = stretch if stretch.isascii() else unicodedata.normalize("NFC", stretch)
        plain = plain.lower() if plain.isascii() else "".join([c.lower() for c in plain])
        if plain.isalpha() and plain.isascii():  # what the automaton would find
            return self.word[plain]
        return sum(map(self.word.__getitem__, self.words(plain)))

    def state_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(open beginning, tokens emitted, open end); without white space (chunk, None, '')."""
        first = _WHITE.search(chunk)
        if not first:
            return chunk, None, ""
        last = max(chunk.rfind(c) for c in set(chunk[first.start() :]) if _WHITE.match(c))
        inner = chunk[first.end() : last + 1]
        stretches = [x for x in _WHITE.split(inner) if x] if _CONTROL.search(inner) else inner.split()
        return chunk[: first.start()], sum(map(self.step.__getitem__, stretches)), chunk[last + 1 :]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[1] is None:
            return (a[0] + b[0], None, "") if b[1] is None else (a[0] + b[0], b[1], b[2])
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        seam = a[2] + b[0]
        return a[0], a[1] + (self.step[seam] if seam else 0) + b[1], b[2]

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """Inclusive prefix scan: pairs are composed, the half as long list is scanned, the rest filled in."""
        if len(maps) < 2:
            return maps
        pairs = self.scan([self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)])
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]))
        return out

    def count(self, text: str, chunk: int = CHUNK) -> int:
        if len(text) <= chunk and not _CONTROL.search(text):
            return sum(map(self.step.__getitem__, text.split()))
        begin, emitted, end = self.scan([self.state_map(text[i : i + chunk]) for i in range(0, len(text), chunk)])[-1]
        return (self.step[begin] if begin else 0) + (emitted or 0) + (self.step[end] if end else 0)


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 2048) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every whole text.

    Strings of special tokens count as one token each. A NULL or empty text has no bytes and no tokens; repeated rows
    and NULL ids stay rows of their own; other columns are not read; an empty table gives an empty result.
    ``vocabulary_path`` must name the file on every executor.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches):
        machine = Transducer.load(vocabulary_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                tokens = [machine.count(text) for text in part["text"].to_pylist()]
                size = pc.cast(pc.binary_length(part["text"]), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], size, pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens])], schema=schema
                )

    return documents(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
