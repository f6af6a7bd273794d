"""The corpus pipeline: STAGES in order, each written as Parquet and read again as the next one's documents.

Defined cases, of every stage: null and empty texts are judged like any text (the rules reject them, having fewer than 20
words); rows with a null doc_id are judged alone and linked with nothing; repeated rows are judged alike, and the join
keeps one row of a doc_id; an empty table gives an empty one; other columns come out of all stages but the last as they went
in, whatever their names. The last stage returns doc_id and the pieces alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, parity_join, quality_cnn, repetition, wfst
from tessera.llm.common import behind_plain_names, discard, materialise, table
from tessera.llm.queries import PIECE_MODEL, domains

#: Shares of tokens after mixing; documents of the first domain stay, the others are thinned out.
TARGETS = {"good": 0.97, "low": 0.01, "toxic": 0.02}


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    model = quality_cnn.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return behind_plain_names(docs, lambda rows: quality_cnn.score(rows, model).filter("quality_ok"), ["quality_score", "quality_ok"])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the repetition limits reject."""
    return behind_plain_names(docs, lambda rows: repetition.judge(rows).filter("kept"), repetition.RESULT.names)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its shingles of five words."""
    return parity_join.one_of_each(docs, parity_join.Measure(k=5, percent=80))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that bring the domains' tokens to their target shares."""
    classifier = mixing.train(table(spark, sf_dir, "documents"), domains(table(spark, sf_dir, "labels")), tuple(sorted(TARGETS)))
    return mixing.mixed(docs, classifier, TARGETS, "good")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces and piece_ids of every document."""
    encoded = wfst.encode(docs.select("doc_id", "text"), PIECE_MODEL)
    return encoded.select("doc_id", F.size("piece_ids").alias("n_pieces"), "piece_ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: A trained network, a fitted mixture and an encoder are among the stages: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name.replace(" ", "-"))
            discard(before)
            before = docs
    return docs
