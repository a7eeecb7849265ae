"""A corpus from documents to packed sequences, one operator per stage.

Each stage works on all rows that the one before kept. Language identification
learns from the labelled rows of its input and drops texts without a letter and
those whose language is ambiguous; the secret scan replaces secrets by a marker
and keeps every document; packing gives the pieces of fixed-length sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import exact_dedup, language, packing, secret_scan, simhash
from tillroll.llm.common import documents, held_out, stored, vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages, beyond doubt."""
    model = language.learn(docs.filter(~held_out()))
    return language.keep_clear(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Fingerprints, language models and token ids are beyond SQL; a test runs plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are stored for the next one."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
