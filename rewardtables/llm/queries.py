"""Registered queries of the operators, over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardtables.llm.byte_bpe import byte_bpe
from rewardtables.llm.chat_format import chat_digests
from rewardtables.llm.common import table
from rewardtables.llm.decontaminate import decontaminate
from rewardtables.llm.embedding import embedding_dedup
from rewardtables.llm.html_text import extract_pages
from rewardtables.llm.minhash import minhash_dedup
from rewardtables.llm.oracles import oracle_sql as oracle_sql
from rewardtables.llm.packing import pack_documents
from rewardtables.llm.quality import quality_scores
from rewardtables.llm.substring import substring_dedup
from rewardtables.llm.suffix_dedup import suffix_dedup
from rewardtables.llm.token_align import token_alignment
from rewardtables.llm.token_codes import token_codes
from rewardtables.llm.whitening import embedding_whitening


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its near-duplicate component."""
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside benchmark windows."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate component."""
    return minhash_dedup(table(spark, sf_dir, "documents")).drop("key")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fuzzy repeated passages."""
    return substring_dedup(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, as read back from its format."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("</s>[INST] ok [/INST]")
    one = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))))).alias("t"),
    )
    return chat_digests(turns.unionByName(one.select("conv_id", "t.turn", "t.role", control.alias("text"))))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what repeated strings take from it."""
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    return extract_pages(table(spark, sf_dir, "pages"))


def op8_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files."""
    return token_codes(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the digests of its ids and of the text decoded from them."""
    return byte_bpe(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened components."""
    return embedding_whitening(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its aligned tokens and their corpus-wide counts."""
    return token_alignment(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of this subpackage."""
    return {
        "op1_embedding_dedup": op1_embedding_dedup,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_decontaminate": op3_decontaminate,
        "op4_minhash_dedup": op4_minhash_dedup,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_chat_format": op6_chat_format,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_token_codes": op8_token_codes,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_html_extract": op10_html_extract,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_token_alignment": op13_token_alignment,
    }
