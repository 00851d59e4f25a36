"""The corpus pipeline: toxic documents go, repeats go, the rest is packed; each stage reads what the one before kept.

Rejected as toxic: a document goes. Repeated runs of lines: they are deleted, and a document of nothing else goes. Near
copies (five words, similarity 0.8): the smallest id of each group stays. Repeated strings of 50 bytes: they are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm import line_winnow, ngram_join, packing, suffix_dedup, toxicity
from tallyworks.llm.common import materialize, table



def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_winnow.without_repeats(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, words=5, percent=80)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers pass from stage to stage with the memory they took, so less is remembered here than in a job of its own
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), held=80_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("suffix_array_dedup", drop_repeated_strings),
    ("best_fit_packing", pack),
]

#: Scores by nearest examples and token ids have no SQL form; the stages are tested against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
