"""Small awkward inputs shared by the tests."""

import random

import pytest

#: Columns whose names the operators use themselves.
CLASHING = {"n": "1", "h": "'x'", "key": "2.5", "length": "7", "bucket": "array(1)", "_text": "'y'", "piece": "0", "component": "null", "words": "'z'"}


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text): NULLs, empty and very long texts, repeated rows, copies, shared passages and lines."""
    chance = random.Random(7)
    words = ["alpha", "Beta", "gamma,", "delta.", "épsilon", "ζeta", "eta!", "theta", "x1", "don't", "$$$", "a|b"]
    say = lambda n: " ".join(chance.choice(words) + str(chance.randint(0, 30)) * chance.randint(0, 1) for _ in range(n))
    passage, line = say(60), say(14)
    rows = [(None, "no id " + passage), (None, None), (1, None), (2, ""), (3, " \n\t\n "), (4, "one"), (5, "one two three")]
    rows += [(i, say(chance.randint(1, 120)) + "\n" + line + "\n" + say(30)) for i in range(10, 30)]
    rows += [(i, say(40) + " " + passage + " " + say(20)) for i in range(30, 36)]
    base = say(200)
    rows += [(40, base), (41, base), (42, base + " end"), (43, "start " + base), (44, base.replace("alpha", "omega", 1))]
    rows += [(50, say(9000)), (51, "ab" * 9000), (52, "same line of ten words or more is written here again\n" * 300)]
    rows += [(60, rows[12][1]), (60, rows[12][1]), (61, "a\rb\x0bc\x1cd\xa0e  f   g \n h"), (62, "<|endoftext|> it's 12 x<|startoftext|>y")]
    return rows


@pytest.fixture(scope="session")
def documents(spark, awkward):
    """The same as a table with further columns, some of whose names clash with the operators' own."""
    frame = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in awkward], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.selectExpr("*", *[f"{value} as {name}" for name, value in CLASHING.items()]).repartition(5)
