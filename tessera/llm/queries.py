"""The registered queries opN_<name>: each applies its operator, with production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import anagram_join, ann, dac, edit_counts, lm_score, merkle, mixing, parity_join, quality_cnn, repetition, simhash_join, url_filter, wfst
from tessera.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary files of public tokenizers; operators take them as parameters.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS, BYTE_PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

#: Shares of tokens that mixing aims at, and its budget: of the tokens of the table.
MIX_TARGETS = {"good": 0.90, "low": 0.04, "toxic": 0.06}
MIX_BUDGET = 1.0


def domains(labels: DataFrame) -> DataFrame:
    """The labelled table of mixing: doc_id and domain."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_pages(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.rules(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_corpus(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.components(table(spark, sf_dir, "documents"), parity_join.Measure(k=4, percent=85))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.count(table(spark, sf_dir, "documents"), BYTE_RANKS, BYTE_PATTERN)


def op8_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dac.scratch_path(spark)
    dac.write(table(spark, sf_dir, "documents"), path, WORD_BPE)
    return dac.digest(spark, path)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.rates(docs, domains(table(spark, sf_dir, "labels")), MIX_TARGETS, MIX_BUDGET).drop("text")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst.digest(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op11_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anagram_join.vendor_clients(table(spark, sf_dir, "clients"), table(spark, sf_dir, "vendors"), 2)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"), merkle.every_third())


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_join.components(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filters": url_filter.ORACLE_SQL,
        "op11_name_join": anagram_join.ORACLE_SQL,
        "op12_merkle_manifest": merkle.oracle_sql(anagram_join.sql_crc("CAST(doc_id AS VARCHAR)")),
    }
