"""One query per operator, over whole tables, with the columns the results are compared by."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    bpe_replay, html_cut, line_winnow, ngram_join, packing, pivots, quality_rules, suffix_dedup, token_counts, toxicity, va_file, whitening, winnowing,
)
from tallyworks.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_html_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_cut.extract(table(spark, sf_dir, "pages"))


def op3_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_replay.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_line_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_winnow.remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.cluster(table(spark, sf_dir, "embeddings"))


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.edits(spark, table(spark, sf_dir, "documents"))
    return found.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_pivot_index, op2_html_cut, op3_bpe_replay, op4_token_counts, op5_line_winnow, op6_packing, op7_toxicity,
        op8_suffix_dedup, op9_ngram_join, op10_quality_rules, op11_whitening, op12_va_file, op13_winnowing,
    )
}
