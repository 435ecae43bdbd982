"""A corpus from raw documents to tokens: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zephyrine.llm import decontaminate, line_dedup, near_copies, sentencepiece, simhash, toxicity
from zephyrine.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose deobfuscated text scores as toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines an earlier line equals, or is one edit from, go; so do documents made of them."""
    return line_dedup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    First by fingerprints of five-word shingles, two bits or less apart; of what they leave,
    documents that share 0.8 of their shingles with an earlier one go.
    """
    return near_copies.first_of_near_copies(simhash.first_of_each_group(docs, words=near_copies.WORDS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` of what is left."""
    return sentencepiece.encode_and_check(docs, sentencepiece.load_pieces())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_texts),
]

# Learned scores and merges of pieces cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every stage reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
