"""Operators as stages of a pipeline: a table of documents in, what they keep of it out.

All rows that stay have all columns of the input, whatever their names. Each stage takes nulls in any
column, empty and very long texts, rows that are alike or share a doc_id, and empty tables; what becomes of
such rows is said at each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.llm import minhash, quality, suffix_dedup
from rewardtables.llm.common import few_rows, free_name, steps
from rewardtables.llm.decontaminate import decontaminate


def _anti(docs: DataFrame, gone: DataFrame, keys: dict[str, F.Column]) -> DataFrame:
    """Rows of docs without those of ``gone``, compared null-safe by expressions over docs."""
    on = None
    for name, value in keys.items():
        part = value.eqNullSafe(gone[name])
        on = part if on is None else on & part
    return docs.join(gone, on, "left_anti")


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = quality.THRESHOLD) -> DataFrame:
    """Rows whose score is not under the threshold.

    A null text is scored as the empty one, copies alike; without a positive label every score is 0.5.
    """
    model = quality.train(docs, labels)
    score = free_name(docs, "_score")
    return quality.scored(docs, model, score).where(F.col(score) >= threshold).drop(score)


def keep_one_of_near_copies(docs: DataFrame) -> DataFrame:
    """The row of smallest doc_id of every group of near-duplicates, and the rows without words.

    Rows that share a doc_id, or have none, are told apart by their sets; of those with equal sets
    one stays. Null and empty texts are near to nothing and stay, one of each doc_id that several rows share.
    """
    key, at = free_name(docs, "_key"), docs.columns.index("text")
    rows = minhash.minhash_dedup(docs)
    several = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_id"))
    several = few_rows(several)
    gone = few_rows(rows.where("not kept").select(F.col("doc_id").alias("_id")).distinct())
    single = _anti(docs, several, {"_id": docs["doc_id"]})
    single = _anti(single, gone, {"_id": docs["doc_id"]})
    if several.isEmpty():
        return single
    # rows of one doc_id: keep the first of each set, if its component is named by that doc_id
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            keys = [minhash.set_key(minhash.shingle_set(t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, key]
            )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    shared = docs.join(several, docs["doc_id"].eqNullSafe(several["_id"]), "left_semi")
    shared = shared.mapInArrow(keyed, f"{ddl}, `{key}` binary").dropDuplicates(["doc_id", key])
    kept = few_rows(
        rows.where("kept").select(F.col("doc_id").alias("_id"), F.col("key").alias("_set")).distinct()
        .join(several, "_id", "left_semi")
    )
    shared = shared.join(
        kept, shared["doc_id"].eqNullSafe(kept["_id"]) & (shared[key] == kept["_set"]), "left_semi"
    )
    return single.unionByName(shared.drop(key))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """All rows, their texts without repeated strings; n_chars, where there is one, follows.

    Null texts stay null. Rows of one doc_id are no earlier documents of each other; a row without doc_id
    keeps its text.
    """
    left = suffix_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.coalesce(size, "n_chars"))
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows that are not contaminated by the benchmark; null and empty texts are not.

    Rows that share a doc_id are told apart by their texts.
    """
    found = decontaminate(docs, benchmark).where("contaminated")
    gone = few_rows(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    return _anti(docs, gone, {"_id": docs["doc_id"], "_hash": F.xxhash64(docs["text"])})
