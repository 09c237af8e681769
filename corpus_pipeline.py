"""A training-data pipeline over ``documents``: five stages, each one of the operators.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns that documents has.  A table between two stages is written and read again.

Cases, at every stage: an empty table gives no rows; other columns, whatever their names, are kept as
they are; rows that repeat a key and a text are one document, each of them kept or dropped alike; rows
that share a key only are documents of their own; a text of any length is worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, jaccard_join, language_id, line_dedup, mixing, sentencepiece_nbest


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one that the labelled ones have; others go: null texts, texts
    without a letter, and those with a posterior under one half."""
    return language_id.keep_known(docs, language_id.train(docs, _vocabulary()))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing else is left; a null text or key is unjudged
    and stays; of equal or similar lines the first by document and place stays."""
    kept = line_dedup.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(common.WORD)
    return kept.where(left).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, directly or through others, the one with the least id stays: by runs
    of five words and a similarity of 0.8.  Documents without words or key link with none and stay."""
    return jaccard_join.one_of_each(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the shares of their weights: documents repeated, or cut to the blocks taken; a null
    source is one of its own, the last; documents without words take no part in the mix and go."""
    return mixing.mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text's best segmentations, with their scores; none for a null or empty text,
    and of equally good ones the one with the longest last piece first."""
    return sentencepiece_nbest.encode(docs, _vocabulary()).select("doc_id", "lang", "source", "n_chars", "ids", "nbest_scores", "nbest_ids")


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("jaccard_join", near_copies),
    ("mixing", mixture),
    ("sentencepiece", pieces),
]

#: The stages learn, hash and search; tests compare them with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
