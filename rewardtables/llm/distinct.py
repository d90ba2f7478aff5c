"""Distinct texts of a table of documents, copies counted once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rewardtables.llm.common import few_rows
from rewardtables.sources.scratch import staged


def distinct_texts(docs: DataFrame, size: Column) -> tuple[DataFrame, DataFrame]:
    """(base, texts).

    ``base`` has every distinct (doc_id, text) once: doc_id, digest, nth, least and the given
    measure of the text; nth counts different texts of one doc_id, least is the smallest doc_id of
    the text. ``texts`` has doc_id, nth and text of those that copy no smaller doc_id; null
    texts and null doc_ids are left out. A null text counts as an empty one in ``base``.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    digest = F.md5(F.col("text").cast("binary")).alias("digest")
    base = staged(docs.select("doc_id", text).select("doc_id", digest, size).distinct(), "digests")
    least = base.groupBy("digest").agg(F.min("doc_id").alias("least"))
    again = base.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("digest"))
    twins = few_rows(
        base.join(again, "doc_id").select("doc_id", "digest", rank.alias("nth")).where("nth > 1")
    )
    nth = F.coalesce("nth", F.lit(1)).alias("nth")
    base = base.join(least, "digest").join(twins, ["doc_id", "digest"], "left")
    base = staged(base.withColumn("nth", nth), "texts")
    copies = few_rows(base.where("doc_id > least").select("doc_id", "digest"))
    texts = (
        docs.where("doc_id is not null and text is not null")
        .select("doc_id", "text", digest)
        .join(copies, ["doc_id", "digest"], "left_anti")
        .join(twins, ["doc_id", "digest"], "left")
        .select("doc_id", nth, "text")
    )
    return base, texts
