"""Risk: the exact pass against sorted draws, and the closed form against both."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rewardtables.operators import risk


def bands(spark, n, dup=False):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")) if dup else F.col("id")
    band = F.element_at(F.array(*[F.lit(b) for b in ("bad", "neutral", "good", "odd")]), (F.col("id") % 4 + 1).cast("int"))
    return spark.range(n).select(key.alias("k"), F.when(F.col("id") % 10 != 9, band).alias("b"))


def brute(df, confidence=0.95, draws=1000, seed=None):
    x = np.array([r["draw"] for r in risk.simulated_draws(df, "b", "k", draws=draws, seed=seed).select("draw").collect()])
    var = np.percentile(x, 100 * (1 - confidence))
    return var, x[x <= var].mean(), len(x)


@pytest.mark.parametrize("confidence", [0.95, 0.5, 0.999])
def test_pass_is_exact(spark, confidence):
    df = bands(spark, 120)
    row = risk.var_cvar(df, "b", "k", confidence=confidence).first()
    var, cvar, n = brute(df, confidence)
    assert row["var"] == pytest.approx(var, abs=1e-12)
    assert row["cvar"] == pytest.approx(cvar, abs=1e-12)
    assert row["n_predictions"] * 1000 == n
    assert row["cvar"] <= row["var"]


def test_repeated_keys_stay_exact(spark):
    # a third of the rows share a key, and so their draws: the first interval may miss
    df = bands(spark, 300, dup=True)
    row = risk.var_cvar(df, "b", "k").first()
    var, cvar, _ = brute(df)
    assert row["var"] == pytest.approx(var, abs=1e-12)
    assert row["cvar"] == pytest.approx(cvar, abs=1e-12)


def test_an_interval_that_misses_is_widened(spark, monkeypatch):
    calls = []
    tail, quantile = risk._tail, risk._mixture_quantile
    monkeypatch.setattr(risk, "_tail", lambda *a: calls.append(a) or tail(*a))
    shift = iter([5.0, 6.0])
    monkeypatch.setattr(risk, "_mixture_quantile", lambda *a: next(shift, None) or quantile(*a))
    df = bands(spark, 40)
    row = risk.var_cvar(df, "b", "k").first()
    assert len(calls) == 2
    assert row["var"] == pytest.approx(brute(df)[0], abs=1e-12)


def test_few_draws(spark):
    df = bands(spark, 3)
    for draws in (1, 2, 7):
        row = risk.var_cvar(df, "b", "k", draws=draws).first()
        var, cvar, _ = brute(df, draws=draws)
        assert row["var"] == pytest.approx(var, abs=1e-12)
        assert row["cvar"] == pytest.approx(cvar, abs=1e-12)


def test_same_draws_on_any_partitioning(spark):
    df = bands(spark, 60)
    a = risk.var_cvar(df.repartition(1), "b", "k", seed=3).first()
    b = risk.var_cvar(df.repartition(7), "b", "k", seed=3).first()
    assert a["var"] == b["var"]
    assert a["cvar"] == pytest.approx(b["cvar"], abs=1e-12)
    assert a["var"] != risk.var_cvar(df, "b", "k", seed=4).first()["var"]


def test_closed_form_is_near_the_simulation(spark):
    df = bands(spark, 400)
    simulated, closed = risk.var_cvar(df, "b", "k").first(), risk.var_cvar_mixture(df, "b").first()
    assert closed["var"] == pytest.approx(simulated["var"], abs=0.01)
    assert closed["cvar"] == pytest.approx(simulated["cvar"], abs=0.01)
    assert closed["n_predictions"] == simulated["n_predictions"]


def test_closed_form_of_one_band(spark):
    row = risk.var_cvar_mixture(bands(spark, 1), "b", dist={"bad": (0.0, 1.0)}).first()
    assert row["var"] == pytest.approx(-1.6448536269514722, abs=1e-9)
    assert row["cvar"] == pytest.approx(-2.0627128075074257, abs=1e-9)


def test_nothing_usable(spark):
    df = spark.createDataFrame([(1, "odd"), (2, None)], "k INT, b STRING")
    assert tuple(risk.var_cvar(df, "b", "k").first()) == (None, None, 0)
    assert tuple(risk.var_cvar_mixture(df, "b").first()) == (None, None, 0)


def test_distribution_without_spread(spark):
    df = spark.createDataFrame([(i, "flat") for i in range(5)], "k INT, b STRING")
    for row in (
        risk.var_cvar(df, "b", "k", dist={"flat": (0.25, 0.0)}, draws=10).first(),
        risk.var_cvar_mixture(df, "b", dist={"flat": (0.25, 0.0)}).first(),
    ):
        assert (row["var"], row["cvar"]) == (pytest.approx(0.25), pytest.approx(0.25))


def grouped(spark, n):
    fold = F.when(F.col("k") % 3 != 0, F.lit(1)).otherwise((F.col("k") % 4).cast("int") + 2)
    return bands(spark, n).withColumns({"fold": F.when(F.col("k") % 11 != 0, fold), "h": F.lit("1y")})


def by_sorting(df, columns, draws=1000):
    out = {}
    for row in df.select(*columns).distinct().collect():
        part = df
        for c in columns:
            part = part.where(F.col(c).eqNullSafe(F.lit(row[c])))
        if risk.usable_predictions(part, "b", risk.BAND_DISTRIBUTIONS).count():
            out[tuple(row)] = brute(part, draws=draws)
    return out


@pytest.mark.parametrize("draws", [1000, 3])
def test_groups_and_totals_in_one_pass(spark, draws):
    df = grouped(spark, 60)
    got = risk.var_cvar_by(df, ["h", "fold"], "b", "k", draws=draws, sets=[["h", "fold"], ["h"], []]).collect()
    want = [(h, f, *x) for (h, f), x in by_sorting(df, ["h", "fold"], draws).items()]
    want += [(h, None, *x) for (h,), x in by_sorting(df, ["h"], draws).items()]
    want += [(None, None, *brute(df, draws=draws))]
    assert len(got) == len(want)
    for row, (h, f, var, cvar, n) in zip(
        sorted(got, key=lambda r: (r.h or "", r.fold or -1, r.n_predictions)),
        sorted(want, key=lambda r: (r[0] or "", r[1] or -1, r[4])),
        strict=True,
    ):
        assert (row.h, row.fold, row.n_predictions * draws) == (h, f, n)
        assert row["var"] == pytest.approx(var, abs=1e-12) and row["cvar"] == pytest.approx(cvar, abs=1e-12)


def test_groups_whose_interval_misses_are_passed_again(spark, monkeypatch):
    calls = []
    tails = risk._group_tails
    monkeypatch.setattr(risk, "_group_tails", lambda u, n, b, *a: calls.append(b.count()) or tails(u, n, b, *a))
    df = grouped(spark, 200)
    got = risk.var_cvar_by(df, ["fold"], "b", "k", width=0.02).collect()
    want = by_sorting(df, ["fold"])
    assert len(calls) > 1 and calls == sorted(calls, reverse=True)
    for row in got:
        assert row["var"] == pytest.approx(want[row.fold,][0], abs=1e-12)
        assert row["cvar"] == pytest.approx(want[row.fold,][1], abs=1e-12)
    assert {row.fold for row in got} == {f for (f,) in want}


def test_groups_without_predictions(spark):
    df = spark.createDataFrame([(1, "odd", 0), (2, None, 1)], "k INT, b STRING, fold INT")
    assert risk.var_cvar_by(df, ["fold"], "b", "k").collect() == []
    with pytest.raises(ValueError, match="grouping sets"):
        risk.var_cvar_by(df, ["fold"], "b", "k", sets=[["other"]])
