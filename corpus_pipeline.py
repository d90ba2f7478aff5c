"""The corpus pipeline: stages that run one after the other over the documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rewardtables.llm import stages
from rewardtables.llm.common import table
from rewardtables.llm.packing import pack_documents
from rewardtables.sources.scratch import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return stages.keep_quality(docs, table(spark, sf_dir, "labels"))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return stages.keep_one_of_near_copies(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document holds are cut out."""
    return stages.cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return stages.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, packed into sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_dedup", minhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: a trained model and token ids: SQL cannot express the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
