"""Rollout operators: golden rows and properties."""

from __future__ import annotations

import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from rewardtables.functions import tokens
from rewardtables.operators import rollouts
from rewardtables.sources import tables


def test_advantage(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 11 == 0 else i // 7 % 30, rng.uniform(-5, 5)) for i in range(600)]
    rows += [(600, 99, 4.0), (601, 98, 2.5), (602, 98, 2.5)]
    df = spark.createDataFrame(rows, "id INT, g INT, r DOUBLE")
    got = {r["id"]: r["advantage"] for r in rollouts.group_advantage(df, "g", "r").collect()}
    assert len(got) == len(rows)
    groups = {}
    for i, g, r in rows:
        groups.setdefault(g, []).append((i, r))
    for members in groups.values():
        values = [r for _, r in members]
        mean = statistics.mean(values)
        std = statistics.stdev(values) if len(values) > 1 else 0.0
        for i, r in members:
            assert got[i] == pytest.approx((r - mean) / (std + 1e-4), abs=1e-9)
        assert sum(got[i] for i, _ in members) == pytest.approx(0.0, abs=1e-6)
    unscaled = rollouts.group_advantage(df, "g", "r", scale=False).where("id = 600").first()
    assert unscaled["advantage"] == 0.0 and "__mean" not in unscaled.asDict()


@pytest.mark.parametrize(
    "response, expected",
    [
        ('{"completion_ids":[[1,2],[]]}', [[1, 2], [9]]),
        ('{"outputs":[{"token_ids":[3]},{"token_ids":[]}]}', [[3], [9]]),
        ('{"completion_ids":[],"outputs":[{"token_ids":[4,5]}]}', [[4, 5]]),
        ('{"completion_ids":[[6]],"outputs":[{"token_ids":[7]}]}', [[6]]),
        ('{"completion_ids":null,"outputs":[]}', [[9]]),
        ("{}", [[9]]),
        (None, [[9]]),
    ],
)
def test_responses(spark, response, expected):
    df = spark.createDataFrame([(response,)], "response STRING")
    got = rollouts.normalise_responses(df, "response", 9)
    assert got.columns == ["response", "completion_ids"]
    assert got.first()["completion_ids"] == expected
    exploded = rollouts.explode_sequences(got).orderBy("pos").collect()
    assert [r["seq"] for r in exploded] == expected


def test_response_logs(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text("\n".join(json.dumps(x) for x in ({"completion_ids": [[1]]}, {"outputs": []})))
    df = rollouts.normalise_responses(tables.read_responses(spark, str(path)), "response", 9)
    assert sorted(r["completion_ids"] for r in df.collect()) == [[[1]], [[9]]]


def test_padding(spark):
    rows = [(1, "a", [1, 2, 3]), (2, "a", [4]), (3, "b", [5]), (4, "a", None), (5, None, [6, 7])]
    df = spark.createDataFrame(rows, "id INT, b STRING, ids ARRAY<INT>")
    got = {r["id"]: r["padded_ids"] for r in rollouts.pad_batch(df, "ids", "b", 0).collect()}
    assert got == {1: [1, 2, 3], 2: [4, 0, 0], 3: [5], 4: [0, 0, 0], 5: [6, 7]}


@pytest.mark.parametrize("eos, pad, filler", [(9, 0, 9), (0, 5, 5), (None, 5, 5), (None, None, 0), (0, 0, 0)])
def test_new_token(spark, eos, pad, filler):
    df = spark.sql("select array(1,2) i, array(1,2) o union all select array(1,2), array(1,2,3)")
    safe = tokens.ensure_new_token(F.col("i"), F.col("o"), eos, pad)
    assert [r[0] for r in df.select(safe).collect()] == [[1, 2, filler], [1, 2, 3]]
    assert df.select(tokens.append_ids(F.col("i"), F.col("o"))).first()[0] == [1, 2, 1, 2]


def test_latest_checkpoint(spark):
    huge = "9" * 30
    rows = [
        ("a", "checkpoint-50", True), ("a", "checkpoint-300", True), ("a", "checkpoint-1000", True),
        ("a", "checkpoint-2000", False), ("a", "checkpoint-3000", None), ("a", "my-checkpoint-4000", True),
        ("a", "checkpoint-5000x", True), ("a", "checkpoint-", True),
        ("b", "checkpoint-x", True),
        ("c", "checkpoint-007", True), ("c", "checkpoint-6", True),
        ("d", f"checkpoint-{huge}", True), ("d", "checkpoint-98", True),
        ("e", "checkpoint-0", True),
    ]
    df = spark.createDataFrame(rows, "run STRING, name STRING, is_dir BOOLEAN")
    df = df.withColumn("path", F.concat(F.lit("out/"), "name"))
    found = rollouts.latest_checkpoint(df).collect()
    got = {r["run"]: (r["latest"], r["step"]) for r in found}
    assert all(r["path"] == "out/" + r["latest"] for r in found)
    assert got == {
        "a": ("checkpoint-1000", 1000),
        "c": ("checkpoint-007", 7),
        "d": (f"checkpoint-{huge}", None),
        "e": ("checkpoint-0", 0),
    }
