"""Band metrics and exact match: golden rows and brute force in Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rewardtables.constants import BAND_ORDINALS
from rewardtables.functions import parse
from rewardtables.operators import metrics, predictions

SCHEMA = "gr STRING, pr STRING, gv STRING, pv STRING"
PAIRS = {"returns": ("gr", "pr"), "volatility": ("gv", "pv")}


def brute(pairs, order):
    """Textbook definitions, one pass per label."""
    n = len(pairs)
    out = {"n": n, "accuracy": None, "f1_weighted": None, "mse": None, "r2": None}
    mapped = [(order[g], order[p]) for g, p in pairs if g in order and p in order]
    out["n_unmapped"] = n - len(mapped)
    if n:
        out["accuracy"] = sum(g == p for g, p in pairs) / n
        total = 0.0
        for label in {x for pair in pairs for x in pair}:
            support = sum(g == label for g, _ in pairs)
            predicted = sum(p == label for _, p in pairs)
            tp = sum(g == p == label for g, p in pairs)
            total += support * 2 * tp / (support + predicted)
        out["f1_weighted"] = total / n
    if mapped:
        sse = sum((g - p) ** 2 for g, p in mapped)
        out["mse"] = sse / len(mapped)
        if len(mapped) > 1:
            mean = sum(g for g, _ in mapped) / len(mapped)
            sst = sum((g - mean) ** 2 for g, _ in mapped)
            out["r2"] = 1 - sse / sst if sst else float(sse == 0)
    return out


def measure(spark, rows, groups=("returns", "volatility")):
    df = metrics.long_pairs(spark.createDataFrame(rows, SCHEMA), PAIRS)
    return {r["band_type"]: r.asDict() for r in metrics.band_metrics(df, groups=groups).collect()}


def check(got, expected):
    for name, value in expected.items():
        assert got[name] == (pytest.approx(value, abs=1e-12) if value is not None else None), name


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (
            rng.choice(["bad", "neutral", "good", None]),
            rng.choice(["bad", "neutral", "good", "odd", None]),
            rng.choice(["low", "medium", "high"]),
            rng.choice(["low", "high", None]),
        )
        for _ in range(500)
    ]
    got = measure(spark, rows)
    returns = [(r[0], r[1]) for r in rows if r[0] and r[1]]
    volatility = [(r[2], r[3]) for r in rows if r[2] and r[3]]
    check(got["returns"], brute(returns, BAND_ORDINALS["returns"]))
    check(got["volatility"], brute(volatility, BAND_ORDINALS["volatility"]))


@pytest.mark.parametrize(
    "pairs, r2",
    [
        ([("good", "good")], None),
        ([("good", "good"), ("good", "good")], 1.0),
        ([("good", "good"), ("good", "bad")], 0.0),
        ([("bad", "good"), ("good", "bad")], -3.0),
        ([("odd", "good"), ("good", "good"), ("bad", "bad")], 1.0),
    ],
)
def test_r2_edges(spark, pairs, r2):
    got = measure(spark, [(g, p, None, None) for g, p in pairs])["returns"]
    assert got["r2"] == r2
    check(got, brute(pairs, BAND_ORDINALS["returns"]))


def test_empty_input_gives_null_rows(spark):
    for rows in ([], [(None, "bad", "low", None)]):
        got = measure(spark, rows)
        assert set(got) == {"returns", "volatility"}
        for row in got.values():
            assert row["n"] == row["n_unmapped"] == 0
            assert all(row[m] is None for m in ("accuracy", "mse", "f1_weighted", "r2"))


def test_each_type_drops_its_own_missing_rows(spark):
    rows = [("bad", "bad", None, "low"), (None, "bad", "low", "low"), ("bad", None, "low", "high")]
    got = measure(spark, rows)
    assert (got["returns"]["n"], got["volatility"]["n"]) == (1, 2)


def test_only_task(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id INT, is_grpo_task BOOLEAN")
    assert [r["id"] for r in metrics.only_task(df).collect()] == [1]


def test_metric_names(spark):
    df = metrics.long_pairs(spark.createDataFrame([("bad", "bad", "low", "low")] * 2, SCHEMA), PAIRS)
    got = {r["metric"]: r["value"] for r in metrics.metric_map(metrics.band_metrics(df), suffix="_1y").collect()}
    assert got["accuracy_returns_1y"] == got["r2_score_volatility_1y"] == got["f1_weighted_returns_1y"] == 1.0
    assert len(got) == 8


def test_exact_match(spark):
    rows = [("[/INST] Yes ", "YES"), ("no", "yes"), ("[/INST]yes", " yes"), (None, "x")]
    df = spark.createDataFrame(rows, "generated STRING, output STRING")
    assert tuple(metrics.exact_match(df).first()) == (4, 1, 0.25)
    assert tuple(metrics.exact_match(df.limit(0)).first()) == (0, 0, None)


@pytest.mark.parametrize(
    "given, expected",
    [
        ("<answer><returns_1y> GOOD </returns_1y></answer>", "good"),
        ("<returns_1y>bad</returns_1y>", "bad"),
        ("<answer><returns_1y>bad</returns_1y><returns_1y>good</returns_1y></answer>", "good"),
        ("<returns_1y>bad</returns_1y><answer>x</answer>", None),
        ("<answer><returns_1y>bad</answer>", None),
        ("<answer>bad</answer>", None),
        ("<answer><returns_1y>great</returns_1y></answer>", None),
        ("prompt <answer><returns_1y>bad</returns_1y></answer> <answer><returns_1y>good</returns_1y>", "good"),
        (None, None),
    ],
)
def test_band_parsing(spark, given, expected):
    df = spark.createDataFrame([(given,)], "completion STRING")
    assert df.select(parse.returns_band(F.col("completion"))).first()[0] == expected
    fields = {"band": ("returns_1y", ["bad", "neutral", "good"])}
    assert predictions.parse_predictions(df, fields).first()["band"] == expected


def test_risk_level(spark):
    df = spark.createDataFrame([("<answer>\n<risk_level>Very High Risk</risk_level>\n</answer>",), ("<risk_level>huge</risk_level>",)], "t STRING")
    assert [r[0] for r in df.select(parse.risk_level(F.col("t"))).collect()] == ["very high risk", None]
    assert df.select(parse.volatility_band(F.lit("<volatility_1y>low</volatility_1y>"))).first()[0] == "low"
