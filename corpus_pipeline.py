"""From raw documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of
``documents``.  What each stage does with nulls, repeated rows and empty tables is
said in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerquarry.llm import (
    minhash_dedup,
    personal_data,
    quality_rules,
    sentence_pieces,
    source_mix,
)
from offerquarry.llm.common import read_table
from offerquarry.sources.shared import write_and_read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash_dedup.keep_one(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced."""
    return personal_data.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return source_mix.mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their SentencePiece pieces."""
    return sentence_pieces.encode(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal),
    ("source_mix", mixing),
    ("sentence_pieces", pieces),
]

#: SQL cannot express the stages; the tests compare with plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
