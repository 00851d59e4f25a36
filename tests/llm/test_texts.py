"""Tokens, packing, quality rules and lines against plain versions."""

import base64
import gc
import hashlib
import random
import re
import time
import weakref
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallyworks.llm import bpe_replay, common, line_winnow, packing, quality_rules, token_counts

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


def rows_of(frame, *columns):
    return Counter(tuple(r[c] for c in columns) for r in frame.collect())


def test_replay_equals_library_and_decodes(documents, awkward):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, text in awkward:
        ids = library.encode_ordinary(text or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want[i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())] += 1
    done = bpe_replay.encode(documents, RANKS, public_tokenizers.PATTERN, with_ids=True)
    assert rows_of(done, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    back = bpe_replay.decode(done, RANKS, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.data).decode()) for r in back.collect()) == Counter((i, t or "") for i, t in awkward)


def test_replay_joins_overlapping_pairs_from_the_left():
    coder = bpe_replay.Replay({b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aaaa": 4}, r"\w+")
    assert coder.replay([b"aaaaa", b"aab", b"a", b"aaaab"]) == [[4, 0], [2, 1], [0], [4, 1]]


def test_counts_equal_library(documents, awkward):
    library = Tokenizer.from_file(WORDS)
    want = Counter()
    for i, text in awkward:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[i, len((text or "").encode()), n, n > 100] += 1
    assert rows_of(token_counts.count_tokens(documents, WORDS, limit=100), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_chunk_maps_compose_wherever_a_text_is_cut(awkward):
    machine = token_counts.Transducer.load(WORDS)
    for _, text in awkward:
        text = (text or "")[:3000]
        assert {machine.count(text, chunk) for chunk in (1, 5, 64, 10**6)} == {machine.count(text)}


def test_very_long_words_equal_library_and_take_no_square_of_time():
    chance = random.Random(21)
    library, machine = Tokenizer.from_file(WORDS), token_counts.Transducer.load(WORDS)
    words = ["".join(chance.choice(letters) for _ in range(n)) for letters in ("ab", "abcdefghij", "thequickbrown", "éa") for n in (63, 64, 65, 200, 3000)]
    words += ["a" * 500, "ab" * 300 + "é" * 40, "!" * 900]
    assert [machine.count(w) for w in words] == [len(library.encode(w, add_special_tokens=False).ids) for w in words]
    start = time.perf_counter()
    assert machine.count("".join(chance.choice("etaoinshr") for _ in range(300_000))) > 50_000
    assert time.perf_counter() - start < 10


def test_plan_is_best_fit_decreasing():
    chance = random.Random(1)
    for _ in range(100):
        size = chance.choice([10, 50])
        lengths = [chance.randint(1, size) for _ in range(chance.randint(0, 150))]
        bins = {}
        for p in packing.plan(Counter(lengths), size):
            for k in range(p.count):
                bins.setdefault(p.bin + k // p.per_bin, []).append((p.offset + k % p.per_bin * p.length, p.length))
        plain = []
        for length in sorted(lengths, reverse=True):
            room = min((r for r in plain if r >= length), default=None)
            if room is None:
                plain.append(size - length)
            else:
                plain[plain.index(room)] -= length
        assert sorted(plain) == sorted(size - sum(n for _, n in b) for b in bins.values())
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length


def test_pieces_hold_the_librarys_ids_and_fill_sequences(documents, awkward):
    library = Tokenizer.from_file(WORDS)
    want, ids_of = Counter(), {}
    for i, text in awkward:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 256):
            data = b"".join(x.to_bytes(4, "little") for x in ids[k : k + 256])
            want[i, k // 256, k, len(ids[k : k + 256]), zlib.crc32(data)] += 1
            ids_of[i, k // 256] = ids[k : k + 256]
    done = packing.pack_documents(documents, WORDS, size=256, with_ids=True).cache()
    assert rows_of(done, "doc_id", "piece", "start", "length", "ids_crc32") == want
    assert all(r.ids == ids_of[r.doc_id, r.piece] for r in done.collect() if r.doc_id and r.doc_id != 60)
    for bin_ in done.toPandas().groupby("sequence_id"):
        placed = sorted(zip(bin_[1]["offset"], bin_[1]["length"], strict=True))
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:k]) for k in range(len(placed))]
        assert sum(n for _, n in placed) <= 256


def test_special_strings_in_other_case_are_plain_text(spark):
    library = Tokenizer.from_file(WORDS)
    texts = ["<|ENDOFTEXT|>", "a<|EndOfText|>B c", "<|STARTOFTEXT|> <|startoftext|>X", "Up<|endoftext|>UP <|endoftext|>", "É<|ENDOFTEXT|>", "A.b <|EndOfText"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.ids for r in packing.pack_documents(docs, WORDS, with_ids=True).collect()}
    assert found == {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    counts = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, WORDS).collect()}
    assert counts == {i: len(ids) - 1 for i, ids in found.items()}


def test_quality_rules_against_loops(documents, awkward):
    want = Counter()
    for i, text in awkward:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        hit = {p for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
        want[i, len(words), len("".join(words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed] += 1
    done = quality_rules.apply_policy(quality_rules.ledger(documents)).cache()
    assert rows_of(done, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert not done.where("kept and failed <> 0").count()
    found = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablations(done).collect()}
    for name, bit in quality_rules.BIT.items():
        masks = [r.failed for r in done.select("failed").collect()]
        assert found[name] == (sum(bool(m & bit) for m in masks), sum(m == bit for m in masks))


def plain_lines(rows, most=10):
    """(text, lines removed, runs) per row, by all windows of all texts."""
    order = sorted({(i if i is not None else 1 << 62, t or "") for i, t in rows})
    strip = " \t\n\x0b\x0c\r"
    windows = {}
    for at, (_, text) in enumerate(order):
        units = [(k, x.strip(strip), len(re.findall(r"[^\x20\x09-\x0D]+", x))) for k, x in enumerate(text.split("\n"))]
        units = [u for u in units if u[2]]
        for a in range(len(units)):
            n = 0
            for b in range(a, len(units)):
                n += units[b][2]
                if n >= most:
                    windows.setdefault(tuple(u[1] for u in units[a : b + 1]), []).append((at, units[a][0], units[b][0]))
                    break
    gone = [set() for _ in order]
    for places in windows.values():
        for at, start, stop in sorted(places)[1:]:
            gone[at].update(range(start, stop + 1))
    out = {}
    for g, (i, text) in zip(gone, order, strict=True):
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in g)
        out[i, text] = kept, len(g), sum(1 for k in g if k - 1 not in g)
    return Counter((i, *out[i if i is not None else 1 << 62, t or ""]) for i, t in rows)


def test_repeated_lines_against_all_windows(documents, awkward):
    unique = [r for r in awkward if r[0] is not None]  # texts without an id are ordered by a hash
    done = line_winnow.remove_repeats(documents.where("doc_id is not null"))
    assert rows_of(done, "doc_id", "text", "n_removed", "n_runs") == plain_lines(unique)
    assert line_winnow.remove_repeats(documents).count() == len(awkward)


def plain_windows(text, most=10):
    """(line, content) of all lines with a word, and (first, last) of each window among them."""
    units = [(k, x.strip(" \t\n\x0b\x0c\r"), len(x.split())) for k, x in enumerate(text.split("\n")) if x.split()]
    found = []
    for a in range(len(units)):
        for b in range(a, len(units)):
            if sum(u[2] for u in units[a : b + 1]) >= most:
                found.append((a, b))
                break
    return units, found


def random_lines(seed, kinds, words, texts=40, longest=40):
    """Texts of few different lines, so that the same line stands in very many surroundings; some texts stand twice."""
    rng = random.Random(seed)
    lines = [" ".join([f"k{i}", *(f"w{rng.randrange(50)}" for _ in range(rng.randint(0, words)))]) for i in range(kinds)]
    rows = [(i, "\n".join(rng.choice([*lines, ""]) for _ in range(rng.randint(0, longest)))) for i in range(texts)]
    return rows + rows[:3]


def test_only_lines_chosen_by_windows_are_kept_as_fingerprints(spark):
    rows = random_lines(3, 30, 4)
    prints = line_winnow.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = {}
    for r in prints:
        of.setdefault(r.place, set()).add((r.at, r.mark, tuple(r.lines), r.centre, tuple((w.first, w.last, w.start, w.stop) for w in r.windows)))
    values = sorted({u[1] for _, text in rows for u in plain_windows(text)[0]})
    hashes = {r.x: r.h for r in spark.createDataFrame([(v,) for v in values], "x string").selectExpr("x", "xxhash64(x) as h").collect()}
    n_windows = 0
    for i, text in dict(rows).items():
        units, windows = plain_windows(text)
        want = {}
        for a, b in windows:  # the rightmost of the smallest hashes
            want.setdefault(max(range(a, b + 1), key=lambda k: (-hashes[units[k][1]], k)), []).append((a, b))
        n_windows += len(windows)
        assert of.get(i, set()) == {
            (
                units[k][0], hashes[units[k][1]], tuple(hashes[u[1]] for u in units[own[0][0] : own[-1][1] + 1]), k - own[0][0],
                tuple((a - own[0][0], b - own[0][0], units[a][0], units[b][0]) for a, b in own),
            )
            for k, own in want.items()
        }
    assert sum(map(len, of.values())) < 0.7 * n_windows


@pytest.mark.parametrize(("kinds", "words", "large"), [(3, 1, 1000), (6, 3, 3), (25, 2, 3), (4, 11, 1000)])
def test_matches_are_extended_from_fingerprints_as_far_as_lines_are_equal(spark, monkeypatch, kinds, words, large):
    monkeypatch.setattr(line_winnow, "LARGE", large)  # 3: most groups are joined without moving their rows
    rows = random_lines(kinds, kinds, words)
    done = line_winnow.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(done, "doc_id", "text", "n_removed", "n_runs") == plain_lines(rows)


def test_documents_of_repeated_lines_go_and_others_stay_whole(documents, awkward):
    left = line_winnow.without_repeats(documents)
    assert left.columns == documents.columns
    ids = {r.doc_id for r in left.collect()}
    assert {1, 2, 3, 4, 10, 40, 50} <= ids and not {41, 60} & ids
    assert left.where("doc_id = 1 and text is null").count() == 1


def test_columns_of_any_name_keep_their_values(spark):
    line = "ten words or more stand in this line of a document"
    rows = [(1, f"first\n{line} here\nend", "a"), (2, f"other start\n{line} here\nlast", "b"), (None, "alone", "c")]
    names = ["_text", "_kept", "_lines", "_place", "_gone", "_version", "c0", "w", "start"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string").selectExpr("doc_id", "text", *[f"concat(mark, '{n}') as `{n}`" for n in names])
    left = line_winnow.without_repeats(docs)
    assert left.columns == docs.columns
    found = {r.doc_id: r for r in left.collect()}
    assert {i: r.text for i, r in found.items()} == {1: rows[0][1], 2: "other start\nlast", None: "alone"}
    assert all(found[i][n] == mark + n for i, _, mark in rows for n in names)


def test_empty_tables(documents):
    none = documents.where("false")
    frames = [
        bpe_replay.encode(none, RANKS, public_tokenizers.PATTERN), token_counts.count_tokens(none, WORDS), packing.pack_documents(none, WORDS),
        quality_rules.ledger(none), quality_rules.ablations(quality_rules.ledger(none)), line_winnow.remove_repeats(none),
        line_winnow.without_repeats(none),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_what_a_worker_forgets_goes_at_once():
    encoder = weakref.ref(packing.Encoder.load(WORDS, 1000))
    encoder().encode("some words, to remember")
    gc.disable()  # its memos refer to it
    try:
        common.forget()
        assert encoder() is None
    finally:
        gc.enable()


def test_other_operators_tasks_drop_what_was_remembered(spark):
    def remember(batches):
        common.remembered(("thing",), dict)
        yield from batches

    def look(batches):
        yield from batches
        assert not common._REMEMBERED

    numbers = spark.range(4).coalesce(1)
    for _ in range(2):
        assert numbers.mapInArrow(remember, "id long").count() == 4
        assert common.map_in_arrow(numbers, look, "id long").count() == 4


def test_free_memory_goes_back_to_the_system():
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4 / 1024

    before = held()
    things = [bytearray(20_000) for _ in range(10_000)]
    last = bytearray(20_000)  # nothing below it can go by itself
    del things
    common.release()
    assert held() < before + 100 and last is not None
