"""Band classification metrics and exact-match accuracy.

All band metrics come from one confusion table: the input is aggregated once,
on (group, truth, prediction), with map-side partial counts; everything after
works on that table's few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardtables.constants import BAND_ORDINALS, INST_CLOSE
from rewardtables.functions.bands import ordinal_of
from rewardtables.functions.text import after_marker
from rewardtables.operators.literals import literal_rows


def only_task(df: DataFrame, flag: str = "is_grpo_task") -> DataFrame:
    """Rows whose flag is true; NULL is not."""
    return df.where(F.coalesce(F.col(flag), F.lit(False)))


def long_pairs(
    df: DataFrame,
    pairs: Mapping[str, tuple[str, str]] | Mapping[tuple[str, ...], tuple[str, str]],
    by: str | Sequence[str] = "band_type",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per (group, truth, prediction), without those where either is missing.

    ``pairs`` maps a group value (a tuple when ``by`` names several columns) to
    its truth and prediction column.
    """
    by = [by] if isinstance(by, str) else list(by)
    cells: list[Column] = []
    for group, (gt, pred) in pairs.items():
        values = [group] if isinstance(group, str) else list(group)
        if len(values) != len(by):
            raise ValueError(f"group {group!r} does not fit columns {by}")
        cells += [F.lit(v) for v in values] + [F.col(gt), F.col(pred)]
    stacked = F.stack(F.lit(len(pairs)), *cells).alias(*by, "gt", "pred")
    return df.select(*keep, stacked).where(F.col("gt").isNotNull() & F.col("pred").isNotNull())


def ordinal(
    df: DataFrame, col: str, band_type: str, out: str | None = None,
    ordinals: Mapping[str, Mapping[str, int]] = BAND_ORDINALS,
) -> DataFrame:
    """Add the ordinal of a band column; ``band_type`` names the column with its type."""
    return df.withColumn(out or f"{col}_ord", ordinal_of(F.col(band_type), F.col(col), ordinals))


def confusion(df: DataFrame, by: str | Sequence[str] = "band_type") -> DataFrame:
    """Counts by group, truth and prediction."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by, "gt", "pred").agg(F.count(F.lit(1)).alias("n"))


def _with_empty_groups(cells: DataFrame, by: list[str], groups) -> DataFrame:
    """Add a zero cell for each expected group, so that one without rows still shows up."""
    rows = [(*([g] if isinstance(g, str) else g), None, None, 0) for g in groups]
    schema = ", ".join(f"`{b}` STRING" for b in by) + ", gt STRING, pred STRING, n BIGINT"
    return cells.unionByName(literal_rows(cells.sparkSession, rows, schema))


def band_metrics(
    df: DataFrame,
    by: str | Sequence[str] = "band_type",
    groups: Sequence | None = None,
    band_type: str = "band_type",
    ordinals: Mapping[str, Mapping[str, int]] = BAND_ORDINALS,
) -> DataFrame:
    """Accuracy, mean squared error, weighted F1 and R² per group, from ``long_pairs`` rows.

    ``n`` counts pairs and ``n_unmapped`` those with a band that has no ordinal;
    the latter stay out of ``mse`` and ``r2`` and count as labels elsewhere.
    Groups listed in ``groups`` give a row of NULL metrics when they have no pair.
    """
    by = [by] if isinstance(by, str) else list(by)
    cells = confusion(df, by)
    if groups is not None:
        cells = _with_empty_groups(cells, by, groups)
    return metrics_from_confusion(cells, by, band_type, ordinals)


def metrics_from_confusion(
    cells: DataFrame,
    by: str | Sequence[str] = "band_type",
    band_type: str = "band_type",
    ordinals: Mapping[str, Mapping[str, int]] = BAND_ORDINALS,
) -> DataFrame:
    """The metrics of ``band_metrics`` from confusion counts."""
    by = [by] if isinstance(by, str) else list(by)
    ordinals_of = {
        out: ordinal_of(F.col(band_type), F.col(label), ordinals).cast("double")
        for out, label in (("g", "gt"), ("p", "pred"))
    }
    cells = cells.withColumns(ordinals_of).selectExpr(
        *by, "gt", "pred", "g", "p", "double(n) AS n", "double(gt = pred) AS hit",
        "double(g IS NOT NULL AND p IS NOT NULL) AS mapped",
    )
    # what a cell adds to its group; it counts with its truth's label only
    cell = {
        "n": "n",
        "hits": "n * hit",
        "m": "n * mapped",
        "sse": "IF(mapped = 1, n * (g - p) * (g - p), 0D)",
        "sum_g": "IF(mapped = 1, n * g, 0D)",
        "sum_gg": "IF(mapped = 1, n * g * g, 0D)",
    }
    truth = {
        "label": "gt", "support": "n", "predicted": "0D", "tp": "n * hit",
        "g": "IF(mapped = 1 AND n > 0, g, NULL)", **cell,
    }
    guess = {
        "label": "pred", "support": "0D", "predicted": "n", "tp": "0D",
        "g": "double(NULL)", **dict.fromkeys(cell, "0D"),
    }

    def struct(fields: Mapping[str, str]) -> str:
        return "struct(" + ", ".join(f"{e} AS {name}" for name, e in fields.items()) + ")"

    labels = cells.selectExpr(*by, f"inline(array({struct(truth)}, {struct(guess)}))")
    sums = ["support", "predicted", "tp", *cell]
    per_label = labels.groupBy(*by, "label").agg(
        *[F.sum(c).alias(c) for c in sums], F.min("g").alias("min_g"), F.max("g").alias("max_g")
    )
    f1 = "IF(support + predicted > 0, 2 * tp / (support + predicted), 0D)"
    totals = per_label.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in cell],
        F.expr(f"sum({f1} * support)").alias("f1_sum"),
        F.min("min_g").alias("min_g"),
        F.max("max_g").alias("max_g"),
    )
    return totals.selectExpr(
        *by,
        "bigint(n) AS n",
        "bigint(n - m) AS n_unmapped",
        "hits / nullif(n, 0) AS accuracy",
        "sse / nullif(m, 0) AS mse",
        "f1_sum / nullif(n, 0) AS f1_weighted",
        """CASE WHEN m < 2 THEN NULL
             WHEN min_g = max_g THEN IF(sse = 0, 1D, 0D)
             ELSE 1 - sse / (sum_gg - sum_g * sum_g / m) END AS r2""",
    )


def metric_map(
    df: DataFrame, by: Sequence[str] = ("band_type",), suffix: str = "", keep: Sequence[str] = ()
) -> DataFrame:
    """Columns ``keep`` and long ``metric, value`` rows named ``<metric>_<group…><suffix>`` from ``band_metrics`` rows."""
    names = ["accuracy", "mse", "f1_weighted", "r2"]
    shown = {"r2": "r2_score"}
    cells = []
    for name in names:
        label = F.concat_ws("_", F.lit(shown.get(name, name)), *[F.col(b) for b in by])
        cells += [F.concat(label, F.lit(suffix)), F.col(name)]
    return df.select(*keep, F.stack(F.lit(len(names)), *cells).alias("metric", "value"))


def exact_match_rows(
    df: DataFrame,
    generated: str = "generated",
    expected: str = "output",
    marker: str = INST_CLOSE,
) -> DataFrame:
    """Add ``prediction`` (text after the last marker) and ``correct``.

    The comparison ignores case; the expected text is not stripped.
    """
    prediction = after_marker(F.col(generated), marker)
    same = F.lower(prediction) == F.lower(F.col(expected))
    return df.withColumns({"prediction": prediction, "correct": same})


def exact_match(
    df: DataFrame,
    generated: str = "generated",
    expected: str = "output",
    marker: str = INST_CLOSE,
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows, hits and accuracy; an empty input gives one row with NULL accuracy."""
    rows = exact_match_rows(df, generated, expected, marker)
    hit = F.coalesce(F.col("correct"), F.lit(False)).cast("bigint")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(hit), F.lit(0)).alias("n_correct"),
        F.avg(hit).alias("accuracy"),
    )
