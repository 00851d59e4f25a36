"""Quality rules as a bitmask ledger, with DataFrame functions only.

Every rule is evaluated once per document: its measurements and one failure bit per rule form the ledger.
Policies are versioned masks over those bits, so a verdict, a changed policy or an ablation never reads a text again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import documents

SPACE = "[ \\t-\\r]+"
SYMBOLS = "[#*$%&|<>]"

#: Rule, and when it fails, over the measurements. The position is the bit; append only.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("no_text", "n_words = 0"),
]
BIT = {name: 1 << at for at, (name, _) in enumerate(RULES)}

#: Named masks: a document fails a policy if one of the policy's bits is set.
POLICIES: dict[str, int] = {
    "base": BIT["few_words"] | BIT["repeated_words"],
    "v1": sum(BIT.values()),
}


def _repeat_words() -> Column:
    """Words inside a three-word window that the text holds twice or more, from ``words``.

    Windows are equal where their 64-bit hashes are. Sorting pairs of hash and position brings equal windows together
    in the order of the text. The positions of the repeated ones, sorted, then cover three words each, less what the
    next one covers too. Everything stays inside the document's row.
    """
    words = F.col("words")
    keys = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.cast("long").alias("at")),
    )

    def covered(rows: Column) -> Column:
        same = lambda i, x: F.coalesce(F.get(rows, i)["h"] == x["h"], F.lit(False))
        repeated = F.filter(rows, lambda x, i: same(i - 1, x) | same(i + 1, x))
        return F.aggregate(
            F.sort_array(F.transform(repeated, lambda x: x["at"])),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3).cast("long"), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    # A lambda's argument is evaluated once, a repeated column expression would be each time.
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(
        F.get(F.transform(F.array(F.sort_array(keys)), covered), F.lit(0))
    )


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of every whole text, each computed once."""
    base = documents(docs).select(
        "doc_id", "text", F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"),
    )
    return base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words().alias("n_repeat_words"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """One row per input row: measurements and ``failed``, the bits of the failed rules.

    A NULL or empty text has zero measurements and fails as such; repeated rows and NULL ids stay rows of their own;
    other columns are not read. An empty table gives an empty ledger.
    """
    measured = measure(docs)
    bits = [F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)) for name, condition in RULES]
    return measured.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits))


def apply_policy(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Add ``base_failed`` and ``kept`` to a ledger, by bits alone."""
    hit = lambda name: F.col("failed").bitwiseAND(F.lit(POLICIES[name])) != 0
    return rows.withColumn("base_failed", hit("base")).withColumn("kept", ~hit("base") & ~hit(policy))


def ablations(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents that fail it, and those the policy would keep without it.

    The ledger is counted per distinct bitmask first (at most two to the number of rules), so rules cost nothing more.
    """
    masks = rows.groupBy("failed").agg(F.count("*").alias("n"))
    mask = POLICIES[policy]
    rules = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(bit).alias("bit")) for name, bit in BIT.items() if bit & mask
    ]))
    spread = masks.select("failed", "n", rules.alias("r")).select("failed", "n", "r.*")
    return spread.groupBy("rule", "bit").agg(
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed").bitwiseAND(F.lit(mask)) == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
    ).drop("bit")
