"""Stages of the pipeline: columns, decisions, rows that share a doc_id."""

from __future__ import annotations

import corpus_pipeline
from rewardtables.llm import decontaminate, minhash, quality, stages

from .helpers import documents

SMALL = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    kept = stages.keep_quality(docs, labels)
    assert ids(kept) == ids(quality.quality_scores(docs, labels).where("predicted = 1"))
    one = stages.keep_one_of_near_copies(kept)
    assert ids(one) == ids(minhash.minhash_dedup(kept).where("kept"))
    cut = stages.cut_repeats(one)
    clean = stages.keep_clean(cut, bench)
    assert ids(clean) == ids(decontaminate.decontaminate(cut, bench).where("not contaminated"))
    for df in (kept, one, cut, clean):
        assert df.schema == docs.schema
    assert all(r.n_chars == len(r.text) for r in clean.collect())


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality_classifier"
    rows = out.collect()
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert rows and max(used.values()) <= 4096


def test_one_of_near_copies_with_shared_ids(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (1, text), (1, "quite another text of some words"), (2, text), (3, None), (3, ""), (None, text), (4, None)]
    got = stages.keep_one_of_near_copies(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in got) == [(1, text), (1, rows[2][1]), (3, ""), (4, "")]


def test_stages_of_empty_tables(spark):
    empty = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (
        stages.keep_quality(empty, labels),
        stages.keep_one_of_near_copies(empty),
        stages.cut_repeats(empty),
        stages.keep_clean(empty, bench),
    ):
        assert out.columns == empty.columns and out.collect() == []


def test_columns_named_as_the_stages_name_theirs(spark):
    rows = [(1, "one two three four five six"), (1, "seven eight nine ten eleven twelve"), (2, None), (2, "x " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("_score", "_removed", "_key", "_id", "_hash", "_set", "score", "digest", "nth", "least", "spans"):
        docs = docs.selectExpr("*", f"'{name}' AS {name}")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    for out, n in (
        (stages.keep_quality(docs, labels, 0.0), 4),
        (stages.keep_one_of_near_copies(docs), 4),
        (stages.cut_repeats(docs), 4),
        (stages.keep_clean(docs, bench), 3),
    ):
        got = out.collect()
        assert out.columns == docs.columns and len(got) == n
        assert all(r[c] == c for r in got for c in docs.columns[2:])
