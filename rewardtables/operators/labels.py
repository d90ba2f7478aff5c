"""Forward returns, volatilities, bands and histories of price series.

The grain is one row per (ticker, month start). ``monthly_prices`` brings any
price table to it with a partially aggregated groupBy, after which a ticker holds
no more rows than the calendar has months; windows per ticker are bounded by
that, whatever share of the raw rows one ticker has. Daily prices are looked up as of
a day instead (``asof_price``). Horizons, cut points and prices are the caller's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def month_index(date: Column) -> Column:
    """Months since year 0, so that calendar distance is subtraction."""
    return F.year(date) * F.lit(12) + F.month(date) - F.lit(1)


def monthly_prices(
    df: DataFrame, ticker: str, date: str, price: str, how=F.avg
) -> DataFrame:
    """``(ticker, date, price)`` with one row per ticker and month; ``how`` aggregates the prices."""
    month = F.trunc(F.col(date).cast("date"), "month")
    return df.groupBy(F.col(ticker).alias(ticker), month.alias(date)).agg(
        how(F.col(price)).alias(price)
    )


def _months(ticker: str, date: str) -> WindowSpec:
    return Window.partitionBy(ticker).orderBy(month_index(F.col(date)))


def _ratio(a: Column, b: Column) -> Column:
    """a / b, NULL for a zero divisor."""
    return a / F.nullif(b, F.lit(0.0))


def forward_return(
    df: DataFrame, ticker: str, date: str, price: str, months: int, out: str = "forward_return"
) -> DataFrame:
    """Add price(date + months) / price(date) − 1, NULL where that month has no price.

    The window's range is on calendar months: ``lead`` counts rows and goes
    wrong wherever a month is missing. Further horizons, volatilities and
    histories of the same series run on the same partitioning and sort order.
    """
    return forward_returns(df, ticker, date, price, {out: months})


def forward_returns(
    df: DataFrame, ticker: str, date: str, price: str, horizons: Mapping[str, int]
) -> DataFrame:
    """``forward_return`` for several horizons, ``{out: months}``, in one pass."""
    series = _months(ticker, date)
    later = {
        f"__{out}": F.max(price).over(series.rangeBetween(months, months))
        for out, months in horizons.items()
    }
    change = {
        out: _ratio(F.col(f"__{out}"), F.col(price)) - F.lit(1.0) for out in horizons
    }
    return df.withColumns(later).withColumns(change).drop(*later)


def daily_prices(
    df: DataFrame, ticker: str, date: str, price: str, how=F.avg
) -> DataFrame:
    """``(ticker, date, price)`` with one row per ticker and day; ``how`` aggregates the prices."""
    day = F.col(date).cast("date")
    return df.groupBy(F.col(ticker).alias(ticker), day.alias(date)).agg(how(F.col(price)).alias(price))


def asof_price(
    df: DataFrame,
    prices: DataFrame,
    ticker: str,
    at: str,
    date: str,
    price: str,
    tolerance: int,
    out: str = "asof_price",
    bucket_days: int = 366,
) -> DataFrame:
    """Add to each row of ``df`` its ticker's last price on or up to ``tolerance`` days before the day ``at``.

    Both tables in one union, the last price over a range frame, no join. Tickers are split by time, into buckets
    of ``bucket_days``; the prices of a bucket's last ``tolerance`` days are carried over to the next, so that
    a bucket alone has all that its rows ask for and a ticker of any length spreads over tasks. Both tables should have
    few rows per ticker and day (``daily_prices``): a bucket is one window.

    NULL where no price is near enough, or ``at`` or the ticker is NULL. NULL prices are passed over; of
    several prices of a day the greatest counts. Rows of ``df`` all stay, repeated ones too.
    """
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")
    width = F.lit(max(bucket_days, tolerance, 1))
    day = F.unix_date(F.col(at).cast("date"))
    asked = df.select(F.col(ticker).alias("__t"), day.alias("__day"), F.struct("*").alias("__asked"))
    # rows without ticker or day find nothing and go anywhere
    nowhere = F.col("__t").isNull() | F.col("__day").isNull()
    own = F.floor(F.col("__day") / width)
    asked = asked.withColumn("__bucket", F.when(nowhere, F.xxhash64("__asked")).otherwise(own))
    known = prices.select(
        F.col(ticker).alias("__t"), F.unix_date(F.col(date).cast("date")).alias("__day"), F.col(price).alias("__price")
    ).dropna()
    reach = F.array_distinct(F.array(own, F.floor((F.col("__day") + F.lit(tolerance)) / width)))
    known = known.withColumn("__bucket", F.explode(reach))
    both = asked.unionByName(known, allowMissingColumns=True)
    so_far = Window.partitionBy("__t", "__bucket").orderBy("__day").rangeBetween(Window.unboundedPreceding, 0)
    offer = F.when(F.col("__price").isNotNull(), F.struct("__day", "__price"))
    found = both.withColumn("__last", F.max(offer).over(so_far)).where(F.col("__asked").isNotNull())
    near = ~nowhere & (F.col("__last.__day") >= F.col("__day") - F.lit(tolerance))
    return found.select("__asked.*", F.when(near, F.col("__last.__price")).alias(out))


def forward_return_asof(
    df: DataFrame, ticker: str, date: str, price: str, months: int, tolerance: int, out: str = "forward_return"
) -> DataFrame:
    """Add price(date + months) / price(date) − 1 to daily prices.

    Where the later day has no price (weekends, holidays) the last one up to ``tolerance`` days before it
    counts, if it is later than ``date`` itself; else NULL.
    """
    if tolerance >= 28 * months:
        raise ValueError("tolerance must be shorter than the horizon")
    later = df.withColumn("__later", F.add_months(F.col(date).cast("date"), months))
    found = asof_price(later, df, ticker, "__later", date, price, tolerance, "__found")
    change = _ratio(F.col("__found"), F.col(price)) - F.lit(1.0)
    return found.withColumn(out, change).drop("__later", "__found")


def log_returns(
    df: DataFrame, ticker: str, date: str, price: str, out: str = "log_return"
) -> DataFrame:
    """Add ln(price / price of the previous calendar month), NULL after a gap."""
    previous = F.max(price).over(_months(ticker, date).rangeBetween(-1, -1))
    ratio = _ratio(F.col(price), F.col("__previous"))
    logs = df.withColumn("__previous", previous).withColumn("__ratio", ratio)
    return logs.withColumn(out, F.when(F.col("__ratio") > 0, F.log("__ratio"))).drop(
        "__previous", "__ratio"
    )


def forward_volatility(
    df: DataFrame, ticker: str, date: str, price: str, months: int, out: str = "forward_volatility"
) -> DataFrame:
    """Add the sample deviation of monthly log returns over the next ``months`` months.

    NULL with fewer than two returns in that span.
    """
    span = _months(ticker, date).rangeBetween(1, months)
    returns = log_returns(df, ticker, date, price, "__log_return")
    return returns.withColumn(out, F.stddev_samp("__log_return").over(span)).drop("__log_return")


def history(
    df: DataFrame,
    ticker: str,
    date: str,
    columns: Sequence[str],
    years: int = 20,
    out: str = "history",
) -> DataFrame:
    """Add the trailing ``years`` years of a ticker, this month included, oldest first.

    Each entry is a struct of ``date`` and ``columns``; at most 12·years entries.
    """
    span = _months(ticker, date).rangeBetween(-(12 * years - 1), Window.currentRow)
    entry = F.struct(F.col(date), *[F.col(c) for c in columns])
    return df.withColumn(out, F.array_sort(F.collect_list(entry).over(span)))


def merge(
    df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join supplementary data to a series on the given keys."""
    return df.join(other, list(keys), how)
