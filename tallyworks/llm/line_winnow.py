"""Removal of repeated runs of lines by winnowing over line hashes, with DataFrame functions only.

A window is a shortest stretch of lines with at least ``min_words`` words. The smallest line hash of each window is a
fingerprint, so two runs with that many words in common are sure to share one. Windows start at every line, but only
the fingerprints chosen are kept, each once, with the lines its windows reach. Places with the same fingerprint are
matched, and the match is extended line by line both ways; windows inside of it are deleted from the later place.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import documents, materialize

SPACES = " \t\n\x0b\x0c\r"
SPACE = "[ \\t-\\r]+"
MIN_WORDS = 10
#: Groups of fingerprints that may be joined by broadcast, and rows that make a group a large one if the whole input has few.
LARGE = 1000


def _fingerprints(lines: Column, min_words: int) -> Column:
    """The lines chosen by windows: ``mark`` (hash), ``at`` (line number), ``lines`` (hashes of the lines within reach of
    these windows), ``centre`` (the chosen one among them) and ``windows`` (``first`` and ``last`` of them, ``start`` and
    ``stop`` in the text)."""
    units = F.filter(
        F.transform(
            lines,
            lambda x, i: F.struct(
                i.alias("at"), F.xxhash64(F.btrim(x, F.lit(SPACES))).alias("h"),
                F.size(F.array_remove(F.split(x, SPACE), "")).alias("words"),
            ),
        ),
        lambda u: u["words"] > 0,
    )

    def stretch(all_units: Column) -> Column:
        stretches = F.transform(
            all_units,
            lambda first, i: F.aggregate(
                F.slice(all_units, i + 1, F.lit(min_words)),  # every line has a word
                F.struct(
                    F.lit(0).alias("words"), i.alias("first"), (i - 1).alias("last"), first["at"].alias("start"), first["at"].alias("stop"),
                    F.struct(first["h"].alias("h"), i.alias("i"), first["at"].alias("at")).alias("mark"),
                ),
                lambda acc, u: F.when(acc["words"] >= min_words, acc).otherwise(
                    F.struct(
                        (acc["words"] + u["words"]).alias("words"), acc["first"].alias("first"), (acc["last"] + 1).alias("last"),
                        acc["start"].alias("start"), u["at"].alias("stop"),
                        F.when(  # of equal ones the last
                            u["h"] <= acc["mark"]["h"], F.struct(u["h"].alias("h"), (acc["last"] + 1).alias("i"), u["at"].alias("at"))
                        ).otherwise(acc["mark"]).alias("mark"),
                    )
                ),
            ),
        )
        return F.filter(stretches, lambda w: w["words"] >= min_words)

    def chosen(all_units: Column, all_windows: Column) -> Column:
        # Windows that choose the same line follow each other, at most one for each word.
        new = F.filter(
            F.transform(all_windows, lambda w, i: F.struct(w["mark"].alias("mark"), i.alias("i"))),
            lambda w: F.coalesce(F.get(all_windows, w["i"] - 1)["mark"]["i"] != w["mark"]["i"], F.lit(True)),
        )
        own = F.transform(
            new,
            lambda w: F.struct(
                w["mark"].alias("mark"),
                F.filter(F.slice(all_windows, w["i"] + 1, F.lit(min_words)), lambda x: x["mark"]["i"] == w["mark"]["i"]).alias("windows"),
            ),
        )
        return F.transform(own, lambda w: reach(all_units, w["mark"], w["windows"], F.get(w["windows"], F.lit(0))["first"]))

    def reach(all_units: Column, mark: Column, windows: Column, first: Column) -> Column:
        last = F.element_at(windows, -1)["last"]
        return F.struct(
            mark["h"].alias("mark"), mark["at"].alias("at"),
            F.transform(F.slice(all_units, first + 1, last - first + 1), lambda u: u["h"]).alias("lines"), (mark["i"] - first).alias("centre"),
            F.transform(
                windows,
                lambda x: F.struct((x["first"] - first).alias("first"), (x["last"] - first).alias("last"), x["start"].alias("start"), x["stop"].alias("stop")),
            ).alias("windows"),
        )

    def once(value: Column, use) -> Column:
        """A lambda's argument is evaluated once, a repeated column expression would be each time."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    return once(units, lambda u: once(stretch(u), lambda w: chosen(u, w)))


def fingerprints(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per line that a window chooses: ``place`` and ``version`` of its text, and what ``_fingerprints`` gives."""
    return documents(docs).select(
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("place"), F.xxhash64("text").alias("version"),
        F.explode(_fingerprints(F.split("text", "\n"), min_words)).alias("w"),
    ).select("place", "version", "w.*")


def _extended(met: DataFrame) -> DataFrame:
    """Extend each match with the head of its group: windows inside (``group`` NULL), and open ones with their new group.

    Two places that share an open window agree with the head up to the same line, and both go on with the same one.
    """
    back = F.least("centre", "head.centre")
    ahead = F.least(F.size("lines") - F.col("centre"), F.size("head.lines") - F.col("head.centre")) - 1

    def steps(most: Column, way: int) -> Column:
        def line(of: str, i: Column) -> Column:
            return F.get(F.col(f"{of}lines"), F.col(f"{of}centre") + way * i)

        return F.aggregate(
            F.sequence(F.lit(0), most), F.lit(-1), lambda n, i: F.when((n == i - 1) & (line("", i) == line("head.", i)), i).otherwise(n)
        )

    met = met.withColumn("low", F.col("centre") - steps(back, -1)).withColumn("high", F.col("centre") + steps(ahead, 1))
    nowhere = F.lit(None)

    def part(group: Column, lines: Column, which) -> Column:
        return F.struct(group.cast("long").alias("group"), lines.cast("array<long>").alias("lines"), F.filter("windows", which).alias("windows"))

    def further(way: int, edge: str) -> Column:
        return F.xxhash64("group", F.lit(way), F.col(edge) - F.col("centre"), F.get(F.col("lines"), F.col(edge) + way))

    parts = F.array(
        part(nowhere, nowhere, lambda w: (w["first"] >= F.col("low")) & (w["last"] <= F.col("high"))),
        part(further(-1, "low"), F.col("lines"), lambda w: w["first"] < F.col("low")),
        part(further(1, "high"), F.col("lines"), lambda w: (w["first"] >= F.col("low")) & (w["last"] > F.col("high"))),
    )
    return met.select("mark", "place", "version", "at", "centre", F.explode(F.filter(parts, lambda p: F.size(p["windows"]) > 0)).alias("p")).select(
        "mark", "place", "version", "at", "centre", "p.*"
    )


def _join(rows: DataFrame, groups: DataFrame, most: int, how: str = "inner") -> DataFrame:
    """Join by ``mark`` and ``group``; rows of a group with more than ``most`` (``n``) stay where they are.

    Fingerprints make at most ``LARGE`` such groups, open windows ``min_words`` times as many. These few rows go to all
    tasks, so that no task gets a whole group.
    """
    keys = ["mark", "group"]
    large = F.broadcast(groups.where(F.col("n") > most))
    others = rows.join(large.select(keys), keys, "left_anti").join(groups.where(F.col("n") <= most), keys, how)
    return rows.join(large, keys, how).unionByName(others)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``place``, ``version`` and ``lines``: per text the numbers of its lines inside later repeats.

    Places with a fingerprint in common are a group, the first of them is its head. The match of every other place with
    the head is extended as far as the lines are equal. Places with windows beyond that meet again in smaller groups, of
    those that go on with the same line. So each is compared with one other at a time, never all pairs. A group's
    places agree in one line more each time, so there are at most ``2 * min_words`` rounds, whatever the input.
    """
    prints = materialize(fingerprints(docs, min_words).withColumn("group", F.lit(0).cast("long")), "line-fingerprints")
    most = max(LARGE, prints.count() // LARGE)
    common = materialize(prints.groupBy("mark", "group").agg(F.count("*").alias("n")).where("n > 1"), "line-marks")
    open_ = materialize(_join(prints, common, most, "left_semi"), "line-matches")
    where = F.struct("place", "version", "at")
    rounds = [open_]
    while not rounds[-1].isEmpty():
        heads = open_.groupBy("mark", "group").agg(
            F.count("*").alias("n"), F.min(where).alias("from"), F.max(where).alias("upto"), F.min_by(F.struct("lines", "centre"), where).alias("head")
        ).where(F.col("from") < F.col("upto")).drop("upto")  # a repeated row is at the same place
        met = _join(open_, materialize(heads, "line-heads"), most).where(where > F.col("from"))
        rounds.append(materialize(_extended(met), "line-matches"))
        open_ = rounds[-1].where("group is not null")
    inside = functools.reduce(DataFrame.unionByName, rounds).where("group is null").select("place", "version", F.explode("windows").alias("w"))
    return inside.groupBy("place", "version").agg(
        F.array_distinct(F.flatten(F.collect_list(F.sequence("w.start", "w.stop")))).alias("lines")  # a text's own lines
    )


def mark_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` (its ``text`` as ``_text``), ``_lines``, and ``_gone``: the numbers of repeated lines."""
    keyed = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    keyed = keyed.withColumn("_place", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)))
    keyed = keyed.withColumn("_version", F.xxhash64("_text"))
    gone = repeated_lines(docs, min_words).select(
        F.col("place").alias("_place"), F.col("version").alias("_version"), F.col("lines").alias("_gone")
    )
    joined = keyed.join(gone, ["_place", "_version"], "left").drop("_place", "_version")
    return joined.withColumn("_lines", F.split("_text", "\n"))


def _kept() -> Column:
    numbers = F.sequence(F.lit(0), F.size("_lines") - 1)
    left = F.transform(F.array_except(numbers, F.col("_gone")), lambda i: F.get(F.col("_lines"), i))
    return F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n"))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``text`` without later repeats, ``n_lines``, ``n_removed`` and ``n_runs`` of every row.

    A line is deleted if it lies in a window of at least ``min_words`` words that also starts earlier, by ``doc_id`` and
    line; blank lines inside such a window go with it. Lines are equal if they are without outer white space. A NULL
    text is the empty one, which has one empty line and loses nothing. Rows without ``doc_id`` come after all others.
    Rows that repeat both id and text are one document: the same lines are deleted in each. Rows that share an id with
    different texts are ordered by a hash of the text. Other columns are not read; an empty table gives an empty result.
    """
    marked = mark_repeats(docs.select("doc_id", "text"), min_words)
    order = F.array_sort(F.coalesce("_gone", F.array().cast("array<int>")))
    runs = F.get(
        F.transform(F.array(order), lambda a: F.size(F.filter(a, lambda x, i: F.coalesce(F.get(a, i - 1) != x - 1, F.lit(True))))),
        F.lit(0),
    )
    return marked.select(
        F.col("doc_id").cast("long").alias("doc_id"), _kept().alias("text"), F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"), runs.cast("long").alias("n_runs"),
    )


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs deleted from ``text``; a document that loses all its words that way goes.

    Its words all stand in earlier documents. Documents without repeats, empty ones among them, stay as they are.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # whatever the columns are called, none clashes
    own = docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in names.items()])
    marked = mark_repeats(own, min_words).withColumn("_kept", _kept())
    marked = marked.where(F.col("_gone").isNull() | F.col("_kept").rlike("[^ \\t-\\r]"))
    out = {"text": F.when(F.col("_gone").isNull(), F.col(names["text"])).otherwise(F.col("_kept"))}
    if "n_chars" in names:
        count = F.length("_kept").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col("_gone").isNull(), F.col(names["n_chars"])).otherwise(count)
    return marked.select(*[out.get(c, F.col(n)).alias(c) for c, n in names.items()])
