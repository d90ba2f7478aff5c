"""Price labels against brute force over a gappy series."""

from __future__ import annotations

import datetime
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from rewardtables.functions import bands
from rewardtables.operators import labels


def series():
    rng = random.Random(7)
    out = {}
    for ticker in ("x", "y"):
        for m in range(90):
            if rng.random() > 0.15:
                out[ticker, m] = round(rng.uniform(50, 150), 2)
    return out


@pytest.fixture(scope="module")
def prices():
    return series()


@pytest.fixture(scope="module")
def df(spark, prices):
    rows = [(t, datetime.date(2000 + m // 12, m % 12 + 1, 1), p) for (t, m), p in prices.items()]
    return spark.createDataFrame(rows, "t STRING, d DATE, p DOUBLE").cache()


def keyed(rows, column):
    return {(r["t"], (r["d"].year - 2000) * 12 + r["d"].month - 1): r[column] for r in rows}


@pytest.mark.parametrize("months", [1, 12, 60])
def test_forward_return(df, prices, months):
    got = keyed(labels.forward_return(df, "t", "d", "p", months).collect(), "forward_return")
    assert set(got) == set(prices)
    for (t, m), value in got.items():
        later = prices.get((t, m + months))
        expected = None if later is None else pytest.approx(later / prices[t, m] - 1)
        assert value == expected


@pytest.mark.parametrize("months", [3, 12])
def test_forward_volatility(df, prices, months):
    got = keyed(labels.forward_volatility(df, "t", "d", "p", months).collect(), "forward_volatility")
    for (t, m), value in got.items():
        returns = [
            math.log(prices[t, k] / prices[t, k - 1])
            for k in range(m + 1, m + months + 1)
            if (t, k) in prices and (t, k - 1) in prices
        ]
        assert value == (pytest.approx(statistics.stdev(returns)) if len(returns) > 1 else None)


def test_history(df, prices):
    rows = labels.history(df, "t", "d", ["p"], years=2).collect()
    for r in rows:
        m = (r["d"].year - 2000) * 12 + r["d"].month - 1
        expected = [prices[r["t"], k] for k in range(m - 23, m + 1) if (r["t"], k) in prices]
        assert [h["p"] for h in r["history"]] == expected


def test_monthly_prices(spark):
    rows = [("x", datetime.datetime(2001, 3, 5, 12), 2.0), ("x", datetime.datetime(2001, 3, 31), 4.0), ("x", datetime.datetime(2001, 4, 1), 7.0)]
    df = spark.createDataFrame(rows, "t STRING, d TIMESTAMP_NTZ, p DOUBLE")
    got = {r["d"]: r["p"] for r in labels.monthly_prices(df, "t", "d", "p").collect()}
    assert got == {datetime.date(2001, 3, 1): 3.0, datetime.date(2001, 4, 1): 7.0}
    top = {r["p"] for r in labels.monthly_prices(df, "t", "d", "p", how=F.max).collect()}
    assert top == {4.0, 7.0}


def test_zero_prices(spark):
    rows = [("x", datetime.date(2001, 1, 1), 0.0), ("x", datetime.date(2001, 2, 1), 4.0), ("x", datetime.date(2001, 3, 1), 5.0)]
    df = spark.createDataFrame(rows, "t STRING, d DATE, p DOUBLE")
    assert [r[-1] for r in labels.forward_return(df, "t", "d", "p", 1).orderBy("d").collect()] == [None, 0.25, None]
    assert [r[-1] for r in labels.log_returns(df, "t", "d", "p").orderBy("d").collect()][:2] == [None, None]


def test_bands(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (None,), (float("nan"),)], "v DOUBLE")
    got = [r[0] for r in df.select(bands.band(F.col("v"), [0.0, 1.0], ["low", "mid", "high"])).collect()]
    assert got == ["low", "mid", "mid", "high", None, None]
    with pytest.raises(ValueError):
        bands.band(F.col("v"), [1.0, 0.0], ["a", "b", "c"])
    with pytest.raises(ValueError):
        bands.band(F.col("v"), [1.0], ["a"])


def daily():
    rng = random.Random(11)
    start = datetime.date(2000, 1, 1)
    days = [start + datetime.timedelta(d) for d in range(1200)]
    return [(t, d, round(rng.uniform(50, 150), 2)) for t, share in (("hot", 0.9), ("thin", 0.05)) for d in days
            if rng.random() < share]


@pytest.mark.parametrize("tolerance, bucket", [(0, 366), (7, 366), (7, 10), (40, 5), (400, 366)])
def test_asof_price_is_the_last_one_near_enough(spark, tolerance, bucket):
    prices = daily()
    rng = random.Random(3)
    asked = [(t, datetime.date(1999, 12, 1) + datetime.timedelta(rng.randrange(1400))) for t in ("hot", "thin", "none")
             for _ in range(300)]
    asked += [(None, datetime.date(2000, 5, 5)), ("hot", None), (None, None), ("hot", datetime.date(2000, 5, 5))] * 2
    left = spark.createDataFrame([(*a, i) for i, a in enumerate(asked)], "t STRING, at DATE, i INT")
    extra = [("hot", datetime.date(2000, 5, 5), None), (None, datetime.date(2000, 5, 5), 1.0), ("hot", None, 1.0)]
    right = spark.createDataFrame(prices + extra, "t STRING, d DATE, p DOUBLE")
    got = labels.asof_price(left, right, "t", "at", "d", "p", tolerance, bucket_days=bucket)
    assert got.columns == ["t", "at", "i", "asof_price"]
    want = []
    for i, (t, at) in enumerate(asked):
        near = [(d, p) for x, d, p in prices if at and x == t and 0 <= (at - d).days <= tolerance]
        want.append((i, max(near)[1] if near else None))
    assert sorted((r["i"], r["asof_price"]) for r in got.collect()) == want


def test_asof_return_and_its_plan(spark):
    prices = daily()
    df = spark.createDataFrame(prices, "t STRING, d DATE, p DOUBLE")
    out = labels.forward_return_asof(df, "t", "d", "p", 12, 5)
    at = {(t, d): p for t, d, p in prices}
    for r in out.collect():
        leap = (r["d"].month, r["d"].day) == (2, 29)
        year_on = r["d"].replace(year=r["d"].year + 1, day=28 if leap else r["d"].day)
        later = [at[r["t"], x] for x in (year_on - datetime.timedelta(k) for k in range(6)) if (r["t"], x) in at]
        if later:
            assert math.isclose(r["forward_return"], later[0] / r["p"] - 1)
        else:
            assert r["forward_return"] is None
    plan = labels.forward_return_asof(df, "t", "d", "p", 12, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    with pytest.raises(ValueError):
        labels.forward_return_asof(df, "t", "d", "p", 1, 28)
    with pytest.raises(ValueError):
        labels.asof_price(df, df, "t", "d", "d", "p", -1)


def test_asof_prices_of_one_day(spark):
    day = datetime.date(2001, 1, 1)
    right = spark.createDataFrame([("x", day, 1.0), ("x", day, 3.0), ("x", day, 2.0)], "t STRING, d DATE, p DOUBLE")
    got = labels.asof_price(right, right, "t", "d", "d", "p", 3).collect()
    assert [r["asof_price"] for r in got] == [3.0] * 3
    assert labels.asof_price(right.limit(0), right, "t", "d", "d", "p", 3).collect() == []
    assert labels.asof_price(right, right.limit(0), "t", "d", "d", "p", 3).where("asof_price IS NULL").count() == 3
