"""Value at risk (VaR) and its tail mean (CVaR) of predicted return bands.

Each band stands for a normal distribution. ``var_cvar_mixture`` answers in
closed form from at most one count per band. ``var_cvar`` draws per prediction,
as the simulated answer is defined, and finds the exact order statistics of all
draws without ever holding them: see there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rewardtables.constants import BAND_DISTRIBUTIONS, CONFIDENCE, DRAWS_PER_PREDICTION
from rewardtables.functions.bands import lookup
from rewardtables.functions.hashing import digest, standard_normal
from rewardtables.operators.literals import literal_rows
from rewardtables.sources.scratch import staged

Distributions = Mapping[str, tuple[float, float]]

_DRAWS_PER_TASK = 10_000_000  # about half a minute of one core
_BINS = 1024

_RESULT = "var DOUBLE, cvar DOUBLE, n_predictions BIGINT"


def usable_predictions(df: DataFrame, band_col: str, dist: Distributions) -> DataFrame:
    """Rows whose predicted band has a distribution."""
    return df.where(F.col(band_col).isin(list(dist)))


def _band_counts(df: DataFrame, band_col: str, dist: Distributions) -> dict[str, int]:
    """Predictions per band: at most one row per entry of ``dist``."""
    rows = usable_predictions(df, band_col, dist).groupBy(F.col(band_col).alias("b")).count()
    return {r["b"]: r["count"] for r in rows.collect()}


def _phi(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def _mixture_cdf(x: float, counts: Mapping[str, int], dist: Distributions) -> float:
    total = sum(counts.values())
    below = 0.0
    for band, n in counts.items():
        mean, std = dist[band]
        below += n * (_phi((x - mean) / std) if std > 0 else float(x >= mean))
    return below / total


def _mixture_quantile(p: float, counts: Mapping[str, int], dist: Distributions) -> float:
    """Least x with CDF(x) ≥ p, by bisection on the mixture's distribution function."""
    if p <= 0.0:
        return -math.inf
    if p >= 1.0:
        return math.inf
    used = [dist[b] for b in counts]
    lo = min(m - 40.0 * s for m, s in used) - 1.0
    hi = max(m + 40.0 * s for m, s in used) + 1.0
    while True:
        mid = (lo + hi) / 2.0
        if mid <= lo or mid >= hi:
            return hi
        if _mixture_cdf(mid, counts, dist) >= p:
            hi = mid
        else:
            lo = mid


def var_cvar_mixture(
    df: DataFrame,
    band_col: str,
    dist: Distributions = BAND_DISTRIBUTIONS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """VaR and CVaR of the mixture of band distributions, without sampling.

    Runs one count per band; the rest is arithmetic on those counts. No usable
    prediction gives one row of NULLs.
    """
    spark = df.sparkSession
    counts = _band_counts(df, band_col, dist)
    total = sum(counts.values())
    if total == 0:
        return literal_rows(spark, [(None, None, 0)], _RESULT)
    var = _mixture_quantile(1.0 - confidence, counts, dist)
    mass = loss = 0.0
    for band, n in counts.items():
        mean, std = dist[band]
        if std > 0:
            z = (var - mean) / std
            density = math.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi)
            mass += n * _phi(z)
            loss += n * (mean * _phi(z) - std * density)
        elif mean <= var:
            mass += n
            loss += n * mean
    return literal_rows(spark, [(var, loss / mass, total)], _RESULT)


def simulated_draws(
    df: DataFrame,
    band_col: str,
    key_col: str,
    dist: Distributions = BAND_DISTRIBUTIONS,
    draws: int = DRAWS_PER_PREDICTION,
    seed: int | None = None,
    tasks: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``draws`` normal values per usable prediction, as ``(key, band, draw_no, draw)`` and the columns to keep.

    Draw i (from 1) of a prediction comes from the hash of (seed, key, i), so it does not
    depend on partitioning, retries or other rows. Narrow rows are spread evenly
    over ``tasks`` (by default the cluster's parallelism) before they multiply.
    """
    if tasks is None:
        tasks = df.sparkSession.sparkContext.defaultParallelism
    band = F.col(band_col)
    prefix = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    if seed is not None:
        prefix = F.concat(F.lit(f"{seed}:"), prefix)
    # all that does not change from draw to draw is worked out per prediction
    predictions = usable_predictions(df, band_col, dist).select(
        F.col(key_col).alias("key"),
        band.alias("band"),
        prefix.alias("prefix"),
        lookup(band, {b: float(m) for b, (m, _) in dist.items()}).alias("mean"),
        lookup(band, {b: float(s) for b, (_, s) in dist.items()}).alias("std"),
        *keep,
    )
    numbered = predictions.repartition(tasks).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw_no")
    )
    z = standard_normal(digest(F.col("prefix"), F.col("draw_no")))
    draw = (F.col("mean") + F.col("std") * z).alias("draw")
    return numbered.select("key", "band", "draw_no", draw, *keep)


def _binned(values: DataFrame, low: float, high: float) -> DataFrame:
    """Distinct values in [low, high] with their count and sum, by bin; all below are bin -1.

    Values above ``high`` are one more group until then, not filtered out first:
    a filter would be pushed below the column and compute each draw twice.
    """
    draw = F.col("draw")
    place = F.lit(0)
    if math.isfinite(low) and math.isfinite(high) and high > low:
        share = (F.col("v") - F.lit(low)) / F.lit(high - low)
        place = F.least(F.floor(share * F.lit(_BINS)), F.lit(_BINS - 1)).cast("int")
    return (
        values.groupBy(
            (draw > F.lit(high)).alias("above"),
            F.when((draw >= F.lit(low)) & (draw <= F.lit(high)), draw).alias("v"),
        )
        .agg(F.count(F.lit(1)).alias("n"), F.sum("draw").alias("s"))
        .where(~F.col("above"))
        .select(F.coalesce(F.when(F.col("v").isNotNull(), place), F.lit(-1)).alias("bin"), "v", "n", "s")
    )


def _ranked(groups: DataFrame, bins: list[int]) -> DataFrame:
    """Values of some bins with the count and sum up to them within their bin."""
    upto = Window.partitionBy("bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return groups.where(F.col("bin").isin(bins)).select(
        "bin", "v", "n", F.sum("n").over(upto).alias("cum_n"), F.sum("s").over(upto).alias("cum_s")
    )


def _tail(
    values: DataFrame, low: float, high: float, ranks: tuple[int, int]
) -> list[tuple[float, int, float]] | None:
    """The order statistics of two ranks (from 0), each with the count and sum of all values up to it.

    None if one lies outside [low, high]. Values are counted per distinct value with
    map-side partial sums and written once. The driver sees the counts of ``_BINS`` bins, and
    only the bins that hold the ranks are put in order, each in a task of its own.
    """
    groups = staged(_binned(values, low, high), "bins")
    totals = groups.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    before, n, total = {}, 0, 0.0
    for row in sorted(totals, key=lambda r: r["bin"]):
        before[row["bin"]] = (n, total, n + row["n"])
        n, total = n + row["n"], total + row["s"]
    homes = [next((b for b, (x, _, y) in before.items() if x <= r < y), -1) for r in ranks]
    if -1 in homes:
        return None
    ranked = _ranked(groups, sorted(set(homes)))

    def holds(rank: int, home: int):
        inside = F.lit(rank - before[home][0])
        return (F.col("bin") == home) & (F.col("cum_n") - F.col("n") <= inside) & (inside < F.col("cum_n"))

    found = ranked.agg(
        *[F.max(F.when(holds(r, b), F.struct("v", "cum_n", "cum_s"))) for r, b in zip(ranks, homes)]
    ).first()
    return [
        (x["v"], before[b][0] + x["cum_n"], before[b][1] + x["cum_s"]) for x, b in zip(found, homes)
    ]


def var_cvar(
    df: DataFrame,
    band_col: str,
    key_col: str,
    dist: Distributions = BAND_DISTRIBUTIONS,
    confidence: float = CONFIDENCE,
    draws: int = DRAWS_PER_PREDICTION,
    seed: int | None = None,
) -> DataFrame:
    """Simulated VaR (percentile, linear interpolation) and CVaR (mean of draws up to it).

    ``percentile`` would bring every draw to one task. Instead the closed form
    gives an interval around the wanted quantile, eight standard errors to either
    side; one pass over the draws counts those below it and keeps those in it,
    about 16·sqrt(p(1−p)·draws in total) of them. Whether the wanted ranks fell
    inside is read off the counts, so the answer is exact: an interval that
    missed is widened and the pass repeated.

    Runs its jobs when called (one count per band, then the pass); the driver
    sees one row per band, and the counts of a fixed number of bins. No usable prediction gives one row of NULLs.
    """
    spark = df.sparkSession
    counts = _band_counts(df, band_col, dist)
    predictions = sum(counts.values())
    if predictions == 0:
        return literal_rows(spark, [(None, None, 0)], _RESULT)
    total = predictions * draws
    p = 1.0 - confidence
    position = (total - 1) * p
    first = math.floor(position)
    second = min(first + 1, total - 1)
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / _DRAWS_PER_TASK))
    values = simulated_draws(df, band_col, key_col, dist, draws, seed, tasks)
    error = math.sqrt(p * (1.0 - p) / total)
    width = 8.0
    while True:
        low = _mixture_quantile(p - width * error - 2.0 / total, counts, dist)
        high = _mixture_quantile(p + width * error + 2.0 / total, counts, dist)
        found = _tail(values, low, high, (first, second))
        if found is not None:
            break
        width *= 8.0
    (a, *_), (b, *_) = found
    var = a + (b - a) * (position - first)
    _, n, total = found[1] if var >= b else found[0]
    cvar = total / n
    return literal_rows(spark, [(var, cvar, predictions)], _RESULT)


_BRACKETS = "home string, n_predictions long, position double, low double, high double"


def _brackets(
    counts: DataFrame, dist: Distributions, confidence: float, draws: int, width: float
) -> DataFrame:
    """``_BRACKETS`` rows from rows (home, bands, ns): the interval around the wanted quantile of each group."""
    names = [f.split()[0] for f in _BRACKETS.split(", ")]
    kinds = [pa.string(), pa.int64(), *[pa.float64()] * 3]
    p = 1.0 - confidence

    def closed_form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                of = dict(zip(row["bands"], row["ns"], strict=True))
                n = sum(of.values())
                slack = width * math.sqrt(p * (1.0 - p) / (n * draws)) + 2.0 / (n * draws)
                ends = (_mixture_quantile(x, of, dist) for x in (p - slack, p + slack))
                out.append((row["home"], n, (n * draws - 1) * p, *ends))
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return counts.mapInArrow(closed_form, _BRACKETS)


def _homes(by: Sequence[str], sets: Sequence[Sequence[str]]) -> Column:
    """The names of the groups that a row belongs to, one for each grouping set."""
    # never a constant, not even for the set of all rows: a join on it stays a join on a key
    names = [F.struct(F.concat(F.lit(f"{i}"), F.substring("band", 1, 0)).alias("set"), *[F.col(c) for c in by if c in s]) for i, s in enumerate(sets)]
    return F.array(*[F.to_json(n) for n in names])


def var_cvar_by(
    df: DataFrame,
    by: Sequence[str],
    band_col: str,
    key_col: str,
    dist: Distributions = BAND_DISTRIBUTIONS,
    confidence: float = CONFIDENCE,
    draws: int = DRAWS_PER_PREDICTION,
    seed: int | None = None,
    sets: Sequence[Sequence[str]] | None = None,
    width: float = 8.0,
) -> DataFrame:
    """The result of ``var_cvar`` for every group: columns ``by``, var, cvar, n_predictions.

    ``sets`` are grouping sets, subsets of ``by``; columns outside a row's set are NULL. All groups of all
    sets come from one pass over the draws, each of which is worked out once: a draw is counted below,
    in or above the interval of each of its groups, by (group, bin). Only groups whose interval missed a rank are
    passed again, with a wider one. No group is gathered in a task: what is put in order are the
    values of the one or two bins of a group that hold its ranks. Groups without a usable prediction have no row.

    The input is read once for the counts per band and once for the draws; write it first where it is costly.
    """
    by = list(by)
    sets = [by] if sets is None else [list(s) for s in sets]
    unknown = {c for s in sets for c in s} - set(by)
    if unknown:
        raise ValueError(f"grouping sets name {sorted(unknown)}, which are not among {by}")
    spark = df.sparkSession
    usable = usable_predictions(df, band_col, dist).select(
        F.col(key_col).alias("key"), F.col(band_col).alias("band"), *by
    )
    usable = usable.withColumn("homes", _homes(by, sets))
    cells = usable.groupBy(*by, "homes", "band").agg(F.count(F.lit(1)).alias("n"))
    cells = staged(cells.select("*", F.posexplode("homes").alias("set", "home")), "band-counts")
    inside = {c: F.array(*[F.lit(i) for i, s in enumerate(sets) if c in s]) for c in by}
    columns = [F.max(F.when(F.array_contains(inside[c], F.col("set")), F.col(c))).alias(c) for c in by]
    names = staged(cells.groupBy("home").agg(*columns), "groups")
    of_band = cells.groupBy("home", "band").agg(F.sum("n").alias("n"))
    counts = of_band.groupBy("home").agg(F.collect_list(F.struct("band", "n")).alias("x"))
    counts = staged(counts.select("home", F.col("x.band").alias("bands"), F.col("x.n").alias("ns")), "group-counts")
    predictions = cells.where("set = 0").agg(F.sum("n")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(predictions * draws / _DRAWS_PER_TASK))

    found: DataFrame | None = None
    open_ = counts
    while predictions:
        brackets = staged(_brackets(open_, dist, confidence, draws, width), "brackets")
        now = staged(_group_tails(usable, len(sets), brackets, dist, draws, seed, tasks), "tails")
        found = now if found is None else found.unionByName(now)
        open_ = open_.join(now.select("home"), "home", "left_anti")
        if open_.isEmpty():
            break
        width *= 8.0
    if found is None:
        found = spark.createDataFrame([], "home STRING, " + _RESULT)
    return names.join(found, "home").select(*by, "var", "cvar", "n_predictions")


def _group_tails(
    usable: DataFrame, n_sets: int, brackets: DataFrame, dist: Distributions, draws: int, seed: int | None, tasks: int
) -> DataFrame:
    """Rows (home, var, cvar, n_predictions) of the groups whose ranks lie in their interval."""
    # the intervals of its groups travel with each prediction
    homes, held_by = usable, []
    for i in range(n_sets):
        interval = brackets.select(F.col("home").alias("__home"), F.struct("home", "low", "high").alias(f"__in_{i}"))
        homes = homes.join(interval, F.col("homes")[i] == F.col("__home"), "left").drop("__home")
        held_by.append(f"__in_{i}")
    homes = homes.select("key", "band", F.filter(F.array(*held_by), lambda h: h.isNotNull()).alias("homes"))
    homes = homes.where(F.size("homes") > 0)
    values = simulated_draws(homes, "band", "key", dist, draws, seed, tasks, keep=["homes"])
    each = values.select("draw", F.explode("homes").alias("h")).select("draw", "h.home", "h.low", "h.high")
    draw, low, high = F.col("draw"), F.col("low"), F.col("high")
    share = F.floor((draw - low) / (high - low) * F.lit(_BINS))
    finite = (high > low) & (high - low < F.lit(math.inf))
    place = F.when(finite, F.least(share, F.lit(_BINS - 1))).otherwise(F.lit(0)).cast("int")
    where = F.when(draw > high, F.lit(_BINS)).when(draw < low, F.lit(-1)).otherwise(place)
    binned = (
        each.groupBy("home", where.alias("bin"), F.when((draw >= low) & (draw <= high), draw).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("draw").alias("s"))
        .where(F.col("bin") < F.lit(_BINS))
    )
    binned = staged(binned, "bins")
    # a group has at most _BINS + 1 rows here
    before = Window.partitionBy("home").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("home", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    bins = bins.select(
        "home", "bin", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("s").over(before), F.lit(0.0)).alias("s0"),
    )
    total = F.col("n_predictions") * F.lit(draws)
    first = F.floor("position")
    ranks = brackets.select(
        "home", "n_predictions", "position",
        F.posexplode(F.array(first, F.least(first + 1, total - 1))).alias("which", "rank"),
    )
    held = bins.join(ranks, "home").where("bin >= 0 AND n0 <= rank AND rank < n0 + n").drop("n")
    upto = Window.partitionBy("home", "bin", "which").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = binned.join(held, ["home", "bin"]).select(
        "home", "n_predictions", "position", "which", "rank", "v", "n", "n0",
        (F.col("n0") + F.sum("n").over(upto)).alias("n1"), (F.col("s0") + F.sum("s").over(upto)).alias("s1"),
    )
    at = ordered.where("n1 - n <= rank AND rank < n1")
    one = F.struct("v", "n1", "s1")
    ends = at.groupBy("home", "n_predictions", "position").agg(
        F.max(F.when(F.col("which") == 0, one)).alias("a"), F.max(F.when(F.col("which") == 1, one)).alias("b")
    )
    var = F.col("a.v") + (F.col("b.v") - F.col("a.v")) * (F.col("position") - F.floor("position"))
    mean = F.when(var >= F.col("b.v"), F.col("b.s1") / F.col("b.n1")).otherwise(F.col("a.s1") / F.col("a.n1"))
    return ends.where("a IS NOT NULL AND b IS NOT NULL").select(
        "home", var.alias("var"), mean.alias("cvar"), "n_predictions"
    )


def metric_rows(
    df: DataFrame, confidence: float = CONFIDENCE, prefix: str = "portfolio", keep: Sequence[str] = ()
) -> DataFrame:
    """Columns ``keep`` and ``metric, value`` rows of VaR / CVaR rows, named after the confidence in per cent."""
    percent = f"{confidence * 100:g}"
    return df.select(
        *keep,
        F.stack(
            F.lit(2),
            F.lit(f"{prefix}_VaR_{percent}"), F.col("var"),
            F.lit(f"{prefix}_CVaR_{percent}"), F.col("cvar"),
        ).alias("metric", "value"),
    )
