"""Plans: what keeps the queries fit for large and skewed tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rewardtables.functions.hashing import key_hash
from rewardtables.operators import metrics, risk, rollouts
from rewardtables.plans import catalog, fixtures
from rewardtables.streaming import periodic

QUERIES = catalog.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_or_python_steps(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert bad not in text
    if name not in ("python_reward", "tokenizer_tail_truncate", "word_tokenizer_tail"):
        assert "EvalPython" not in text and "MapInPandas" not in text


@pytest.mark.parametrize(
    "name", sorted(set(QUERIES) - {"fold_file_summary"})
)
def test_nothing_moves_to_a_single_partition(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    if "Exchange SinglePartition" in text:
        # only the last step of a global aggregate, one row per task
        above = text.split("Exchange SinglePartition")[0].rsplit("\n", 2)
        assert name == "benchmark_exact_match" and "HashAggregate(keys=[]" in above[-2]


READS = {
    "band_metrics_all": {"doc_id", "quality", "toxic", "n_chars"},
    "group_relative_advantage": {"event_id", "value"},
    "latest_checkpoint": {"o_orderkey", "o_custkey"},
    "windowed_eval": {"event_id", "ts", "user_id", "event_type", "props"},
    "forward_return": {"o_orderpriority", "o_orderdate", "o_totalprice"},
    "parse_risk_level": {"doc_id", "quality", "toxic", "n_chars", "text"},
    "benchmark_exact_match_all": {"doc_id", "lang"},
}


@pytest.mark.parametrize("name", sorted(READS))
def test_scans_read_needed_columns_only(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    read = set()
    for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", text):
        read |= {field.split(":")[0] for field in re.split(r",(?![^<]*>)", schema)}
    assert read <= READS[name]


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["xml_answer_extract"](spark, sf_dir))
    assert "EqualTo(role,assistant)" in text and "EqualTo(role,user)" in text


def test_sampling_cuts_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["periodic_eval"](spark, sf_dir))
    # counts by bucket and slot travel first; rows only once the join has cut them
    assert "eval_step" in text and text.count("Window ") == 2 and "SinglePartition" not in text


def test_a_hot_bucket_is_sampled_exactly(spark):
    # two thirds of the rows in one bucket, spread over many tasks
    step = F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7))
    df = spark.range(0, 30_000, 1, 40).withColumn("step", step)
    sampled = periodic.sample_per_bucket(df, "step", "id", every=1000, samples=20)
    got = {(r["eval_step"], r["id"]) for r in sampled.collect()}
    ranked = {}
    for r in df.withColumn("h", key_hash(42, F.col("id"))).collect():
        ranked.setdefault(r["step"] // 1000 * 1000, []).append((r["h"], r["id"]))
    assert got == {(b, i) for b, rows in ranked.items() for _, i in sorted(rows)[:20]}


def test_first_rows_are_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["instruction_concat_first_n"](spark, sf_dir))


def test_metrics_shuffle_counts_only(spark, sf_dir):
    text = plan(metrics.band_metrics(metrics.long_pairs(
        fixtures.predictions(spark, sf_dir), {"returns": ("gt_ret_1y", "pred_ret_1y")}
    )))
    first = text.rsplit("Exchange hashpartitioning(band_type", 1)[1]
    assert "partial_count" in first


def hot(spark, rows=600_000):
    """A third of the rows in one group."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.expr("id div 7"))
    return spark.range(0, rows, 1, 8).select(
        "id", key.alias("g"), (F.col("id") % 1000).cast("double").alias("r"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )


def test_a_hot_group_is_split(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    old = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        out = rollouts.group_advantage(hot(spark), "g", "r")
        total = out.agg(F.count(F.lit(1)), F.sum("advantage"), F.max(F.length("payload")))
        n, advantage, _ = total.collect()[0]
        final = total._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert n == 600_000 and advantage == pytest.approx(0.0, abs=1e-3)
    assert "skew=true" in final


def test_hot_group_matches_the_plain_window(spark):
    df = hot(spark, 30_000)
    got = rollouts.group_advantage(df, "g", "r").select("id", F.round("advantage", 6).alias("a"))
    w = "over (partition by g)"
    df.createOrReplaceTempView("hot")
    expected = spark.sql(
        f"select id, round((r - avg(r) {w}) / (coalesce(stddev_samp(r) {w}, 0) + 1e-4), 6) as a from hot"
    )
    assert got.exceptAll(expected).count() == 0 and got.count() == 30_000


def test_quantile_steps_have_no_window_without_a_key(spark):
    values = spark.range(1000).selectExpr("id / 1000.0D AS draw")
    groups = risk._binned(values, 0.1, 0.4)
    assert "SinglePartition" not in plan(groups)
    assert "SinglePartition" not in plan(risk._ranked(groups, [3, 4]))
