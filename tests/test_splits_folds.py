"""Splits, fold summaries, fold files, tables."""

from __future__ import annotations

import json
import os
import statistics

import pytest

from rewardtables.operators import folds, splits
from rewardtables.sources import fold_files, scratch, tables


def keys(spark, n=2000, parts=4):
    return spark.range(0, n, 1, parts).withColumnRenamed("id", "k")


def test_folds_do_not_depend_on_partitioning(spark):
    a = {tuple(r) for r in splits.kfold(keys(spark), "k", 5).collect()}
    b = {tuple(r) for r in splits.kfold(keys(spark).repartition(7), "k", 5).collect()}
    assert a == b
    sizes = [sum(f == i for _, f in a) for i in range(5)]
    assert sum(sizes) == 2000 and min(sizes) > 330
    assert a != {tuple(r) for r in splits.kfold(keys(spark), "k", 5, seed=1).collect()}


def test_holdout_share(spark):
    n = splits.holdout(keys(spark), "k", 0.2).where("split = 'test'").count()
    assert 330 < n < 470
    assert splits.holdout(keys(spark), "k", 0.0).where("split = 'test'").count() == 0
    assert splits.holdout(keys(spark), "k", 1.0).where("split = 'train'").count() == 0


@pytest.mark.parametrize("k_folds", [1, 3])
def test_sides_partition_the_rows(spark, k_folds):
    df = keys(spark)
    train, test = (
        {r["k"] for r in splits.load_split(df, "k", side, k_folds=k_folds, fold_index=0).collect()}
        for side in ("train", "test")
    )
    assert not train & test and len(train | test) == 2000 and test


def test_missing_keys_are_kept(spark):
    df = spark.createDataFrame([(None,), ("a",)], "k STRING")
    assert splits.kfold(df, "k", 3).where("fold is null").count() == 0
    sides = [splits.load_split(df, "k", side) for side in ("train", "test")]
    assert sum(side.count() for side in sides) == 2


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        splits.load_split(keys(spark), "k", "valid")
    with pytest.raises(ValueError):
        splits.load_split(keys(spark), "k", "test", k_folds=3, fold_index=3)
    with pytest.raises(ValueError):
        splits.kfold(keys(spark), "k", 0)


def test_summary_skips_missing_values(spark):
    rows = [(0, "a", 1.0), (1, "a", 4.0), (2, "a", float("nan")), (3, "a", None), (0, "b", 2.0), (0, "c", None)]
    got = {r["metric"]: (r["mean"], r["std_dev"]) for r in folds.summarise(spark.createDataFrame(rows, "fold INT, metric STRING, value DOUBLE")).collect()}
    assert got == {"a": (2.5, pytest.approx(statistics.stdev([1, 4]))), "b": (2.0, None), "c": (None, None)}


def test_append_and_long_form(spark):
    a = spark.createDataFrame([(0, 1.0)], "fold INT, x DOUBLE")
    b = spark.createDataFrame([(1, 2.0)], "fold INT, y DOUBLE")
    got = {tuple(r) for r in folds.to_long(folds.append_folds(a, b)).collect()}
    assert got == {(0, "x", 1.0), (0, "y", None), (1, "x", None), (1, "y", 2.0)}


def write(base, fold, text):
    os.makedirs(f"{base}/{fold}")
    with open(f"{base}/{fold}/evaluation_metrics.json", "w") as f:
        f.write(text)


def test_reading_fold_files(spark, tmp_path):
    base = str(tmp_path)
    write(base, "fold_0", json.dumps({"acc": 0.5, "n": 3}, indent=2))
    write(base, "fold_2", '{"acc": NaN}')
    write(base, "fold_7", '{"acc": 9.0}')
    write(base, "fold_01", '{"acc": 9.0}')
    write(base, "cv_fold_1", '{"acc": 9.0}')
    df = fold_files.read_fold_metrics(spark, base, 5)
    got = {(r["fold"], r["metric"]): r["value"] for r in df.collect()}
    assert set(got) == {(0, "acc"), (0, "n"), (2, "acc")}
    assert {r["metric"]: r["mean"] for r in folds.summarise(df).collect()} == {"acc": 0.5, "n": 3.0}
    assert sorted(r["fold"] for r in folds.missing_folds(df, 5).collect()) == [1, 3, 4]
    status = {r["fold"]: r["found"] for r in folds.fold_status(df, 3).collect()}
    assert status == {0: True, 1: False, 2: True}


def test_odd_metric_values(spark, tmp_path):
    base = str(tmp_path)
    write(base, "fold_0", '{"a": true, "b": "text", "c": -Infinity, "d": {"x": 1}, "e": 2, "f": null}')
    got = {r["metric"]: r["value"] for r in fold_files.read_fold_metrics(spark, base, 1).collect()}
    assert got == {"a": 1.0, "b": None, "c": float("-inf"), "d": None, "e": 2.0, "f": None}
    write(base, "fold_1", "no json")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        fold_files.read_fold_metrics(spark, base, 2).collect()


def test_no_fold_files(spark, tmp_path):
    df = fold_files.read_fold_metrics(spark, str(tmp_path), 3)
    assert df.columns == ["fold", "metric", "value"] and df.count() == 0
    assert folds.summarise(df).count() == 0
    assert folds.missing_folds(df, 3).count() == 3


def test_fold_files_round_trip(spark, tmp_path):
    base = f"{tmp_path}/run"
    rows = [(0, "acc", 0.1 + 0.2), (0, "n", 7.0), (2, "acc", float("nan")), (2, "n", 1.5)]
    schema = "fold INT, metric STRING, value DOUBLE"
    for _ in range(2):  # the second write replaces the first
        fold_files.write_fold_metrics(spark.createDataFrame(rows, schema), base)
    with open(f"{base}/fold_0/evaluation_metrics.json") as f:
        assert json.load(f) == {"acc": 0.1 + 0.2, "n": 7.0}
    with open(f"{base}/fold_2/evaluation_metrics.json") as f:
        assert json.load(f) == {"acc": None, "n": 1.5}
    assert sorted(x for x in os.listdir(base) if not x.startswith(".")) == ["fold_0", "fold_2"]
    got = {tuple(r) for r in fold_files.read_fold_metrics(spark, base, 5).collect()}
    assert got == {(0, "acc", 0.1 + 0.2), (0, "n", 7.0), (2, "acc", None), (2, "n", 1.5)}


def test_split_of_a_table(spark, tmp_path):
    path = f"{tmp_path}/qa"
    df = spark.createDataFrame([("q1", "a1", "train"), ("q2", "a2", "test")], "question STRING, answer STRING, split STRING")
    df.write.partitionBy("split").parquet(path)
    got = tables.read_table(spark, path, "question STRING, answer STRING", split="test")
    assert [tuple(r) for r in got.collect()] == [("q2", "a2", "test")]
    assert "split#" in got._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]
    plain = f"{tmp_path}/plain"
    tables.write_results(df.drop("split"), plain)
    assert tables.read_table(spark, plain, "question STRING, answer STRING").count() == 2
    with pytest.raises(ValueError):
        tables.read_table(spark, plain, "question STRING, answer STRING", split="test")


def test_json_tables_and_metric_sink(spark, tmp_path):
    path = f"{tmp_path}/m"
    tables.write_metrics(spark.createDataFrame([("acc", 0.5)], "metric STRING, value DOUBLE"), path)
    back = tables.read_table(spark, path, "metric STRING, value DOUBLE", fmt="json")
    assert [tuple(r) for r in back.collect()] == [("acc", 0.5)]


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_dir(spark, "x").startswith(f"{shared}/x-")
    assert scratch.scratch_dir(spark, "x") != scratch.scratch_dir(spark, "x")


class _Session:
    """A session without the shared folder."""

    class conf:
        get = staticmethod(lambda name, default: default)

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_needs_a_shared_folder_on_a_cluster():
    assert scratch.scratch_dir(_Session("local[2]"), "x").startswith("/tmp/checkpoints/x-")
    with pytest.raises(RuntimeError):
        scratch.scratch_dir(_Session("yarn"), "x")
