"""The evaluation by fold, versions of small results, the mergeable confusion state."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from rewardtables.operators import evaluation, folds, metrics, risk
from rewardtables.sources import fold_files, versions

PAIRS = {
    ("returns", "1y"): ("gr", "pr"),
    ("volatility", "1y"): ("gv", "pv"),
    ("returns", "5y"): ("gr5", "pr5"),
}
SCHEMA = "id INT, fold INT, gr STRING, pr STRING, gv STRING, pv STRING, gr5 STRING, pr5 STRING"


def examples(spark, n, missing_fold=3):
    r = random.Random(4)
    pick = lambda *names: r.choice(names)
    rows = []
    for i in range(n):
        fold = r.choice([f for f in range(5) if f != missing_fold])
        returns = [pick("bad", "neutral", "good", None) for _ in range(4)]
        rows.append((i, fold, *returns[:2], pick("low", "high", "odd"), pick("low", "medium", None), *returns[2:]))
    return spark.createDataFrame(rows, SCHEMA)


def test_folds_and_total_equal_separate_evaluations(spark):
    df = examples(spark, 90)
    got = {(r.fold, r.metric): r.value for r in evaluation.evaluate(df, PAIRS, "id", 5).collect()}
    for fold in (None, 0, 1, 2, 3, 4):
        part = df if fold is None else df.where(F.col("fold") == fold)
        by = ["band_type", "horizon"]
        pairs = metrics.long_pairs(part, PAIRS, by=by)
        want = {
            r.metric: r.value
            for r in metrics.metric_map(metrics.band_metrics(pairs, by=by, groups=list(PAIRS)), by=by).collect()
        }
        for column, suffix in (("pr", ""), ("pr5", "_5y")):
            row = risk.var_cvar(part, column, "id").first()
            want |= {f"portfolio_VaR_95{suffix}": row["var"], f"portfolio_CVaR_95{suffix}": row["cvar"]}
        assert {m for f, m in got if f == fold} == set(want)
        for name, value in want.items():
            assert got[fold, name] == (None if value is None else pytest.approx(value, abs=1e-9)), (fold, name)
    assert all(v is None for (f, m), v in got.items() if f == 3)


def test_an_evaluation_of_nothing(spark):
    got = evaluation.evaluate(examples(spark, 0), PAIRS, "id", 2).collect()
    assert len(got) == 3 * (3 * 4 + 2 * 2) and all(r.value is None for r in got)


FOLDS = "fold INT, metric STRING, value DOUBLE"


def test_a_reader_sees_whole_versions(spark, tmp_path):
    base = f"{tmp_path}/run"
    first = [(f, "acc", f / 10) for f in range(5)]
    second = [(f, "acc", f / 20) for f in range(4)] + [(1, "nan", float("nan"))]
    read = lambda: fold_files.read_fold_metrics(spark, base, 5)
    assert read().count() == 0
    fold_files.publish_fold_metrics(spark.createDataFrame(first, FOLDS), base)
    before = read()
    seen = []
    write = lambda path: (fold_files._texts(spark.createDataFrame(second, FOLDS)).write.partitionBy("fold").text(path), seen.append({tuple(r) for r in read().collect()}))
    versions.publish(spark, base, write)
    # in the midst of the second write, and by a table that was opened before it
    assert seen == [set(first)] and {tuple(r) for r in before.collect()} == set(first)
    got = {tuple(r) for r in read().collect()}
    assert got == {(f, m, None if v != v else v) for f, m, v in second}
    assert [r.fold for r in folds.missing_folds(read(), 5).collect()] == [4]


def test_failed_writes_change_nothing_and_old_versions_go(spark, tmp_path):
    base = f"{tmp_path}/run"
    for i in range(4):
        fold_files.publish_fold_metrics(spark.createDataFrame([(0, "i", float(i))], FOLDS), base, keep=2)

    def broken(path):
        os.makedirs(path)
        raise OSError("no room")

    with pytest.raises(OSError):
        versions.publish(spark, base, broken)
    assert fold_files.read_fold_metrics(spark, base, 1).first()["value"] == 3.0
    kept = versions.current_runs(spark, base)
    assert len(kept) == 2 and all(os.path.isdir(f"{base}/{run}") for run in kept)
    fold_files.publish_fold_metrics(spark.createDataFrame([], FOLDS), base)
    assert fold_files.read_fold_metrics(spark, base, 5).count() == 0


def test_increments_and_a_replay_equal_the_batch(spark, tmp_path):
    path, by = f"{tmp_path}/state", ["band_type", "horizon"]
    assert evaluation.read_state(spark, path, by).count() == 0
    pairs = metrics.long_pairs(examples(spark, 120), PAIRS, by=by, keep=["id"])
    parts = [pairs.where(F.col("id") % 3 == i).drop("id") for i in range(3)]
    added = [evaluation.append_state(metrics.confusion(parts[i], by), path, i, by) for i in (0, 1, 1, 2, 0)]
    assert added == [True, True, False, True, False]
    state = evaluation.read_state(spark, path, by)
    whole = metrics.confusion(pairs, by)
    assert {tuple(r) for r in state.collect()} == {tuple(r) for r in whole.select(state.columns).collect()}
    got = metrics.metrics_from_confusion(state, by).orderBy(*by).collect()
    want = metrics.band_metrics(pairs, by).orderBy(*by).collect()
    assert [r.asDict() for r in got] == [pytest.approx(r.asDict()) for r in want]


def test_an_empty_batch_counts_as_seen(spark, tmp_path):
    path, by = f"{tmp_path}/state", ["band_type"]
    none = spark.createDataFrame([], "band_type STRING, gt STRING, pred STRING")
    assert evaluation.append_state(metrics.confusion(none, by), path, 7, by)
    assert not evaluation.append_state(metrics.confusion(none, by), path, 7, by)
    assert evaluation.read_state(spark, path, by).count() == 0
