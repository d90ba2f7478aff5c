"""Known figures of the derived tables at scale factor 0.01."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from rewardtables.operators import scorecard
from rewardtables.plans import catalog, fixtures

pytestmark = pytest.mark.skipif(
    "TEST_SF_DIR" in os.environ, reason="figures hold for the default data only"
)
QUERIES = catalog.queries()


def test_completion_variants(spark, sf_dir):
    scored = scorecard.scorecard(fixtures.completions(spark, sf_dir), ["correctness", "strict_format"])
    got = {
        r["variant"]: (r["n"], r["f"], r["c"])
        for r in scored.groupBy("variant")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("reward_strict_format").alias("f"), F.sum("reward_correctness").alias("c"))
        .collect()
    }
    assert got == {
        0: (32, 16.0, 64.0), 1: (28, 2.5, 56.0), 2: (33, 0.0, 66.0), 3: (27, 0.0, 54.0),
        4: (33, 0.0, 0.0), 5: (24, 12.0, 0.0), 6: (30, 0.0, 60.0), 7: (26, 0.0, 52.0),
    }


def test_risk_figures(spark, sf_dir):
    assert tuple(QUERIES["var_cvar_simulated"](spark, sf_dir).first()) == (-0.358892, -0.458735, 360)
    assert tuple(QUERIES["var_cvar_mixture"](spark, sf_dir).first()) == (-0.35803, -0.458732, 360)


def test_fold_sizes(spark, sf_dir):
    rows = QUERIES["kfold_assign"](spark, sf_dir).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in rows] == [87, 70, 77, 78, 87]
    assert [r["fold"] for r in QUERIES["missing_folds"](spark, sf_dir).collect()] == [3]


def test_benchmark_accuracy(spark, sf_dir):
    assert QUERIES["benchmark_exact_match"](spark, sf_dir).first()["accuracy"] == 0.734


def test_checkpoints(spark, sf_dir):
    steps = QUERIES["checkpoint_steps"](spark, sf_dir)
    assert steps.where("is_dir and step is not null").count() == 8571
    assert QUERIES["latest_checkpoint"](spark, sf_dir).count() == 1493


def test_task_flags(spark, sf_dir):
    flags = fixtures.band_texts(spark, sf_dir).groupBy("is_grpo_task").count().collect()
    assert {r["is_grpo_task"]: r["count"] for r in flags} == {True: 293, False: 45, None: 61}


def test_series_has_gaps(spark, sf_dir):
    series = fixtures.series(spark, sf_dir, gaps=True)
    lead = series.selectExpr(
        "ticker", "month", "lead(month, 12) over (partition by ticker order by month) as by_rows",
        "add_months(month, 12) as by_calendar",
    )
    assert series.count() == 393
    assert lead.where("by_rows > by_calendar").count() > 0
