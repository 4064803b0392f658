"""The corpus pipeline: language, line dedup, near dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written and read again for the
next one. All but the last return the columns of documents: texts that a stage changes are changed, with
``n_chars`` brought up to date, and rows it drops are gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import language, line_dedup, near_dedup, packing, pii
from feedloom.llm.common import documents
from feedloom.llm.queries import tokenizer_file
from feedloom.session import pinned


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest centroid does not reject."""
    return language.keep_known(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are deleted; a document of nothing else goes."""
    return line_dedup.without_repeats(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by marks."""
    return pii.redacted(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language", known_languages),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_copies),
    ("pii", personal_data),
    ("packing", sequences),
]

# Language, near-duplicate and packing stages go beyond SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
