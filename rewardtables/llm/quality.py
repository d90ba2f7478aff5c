"""Operator 9: a quality classifier from trusted positives and unlabelled web text.

Trusted positives are documents labelled 1; all other text is unlabelled. A linear model on
statistics of the whole text minimises the non-negative unbiased risk

    prior * R(positives as 1) + max(0, R(unlabelled as 0) - prior * R(positives as 0))

with the logistic loss. The class prior is estimated from the scores of a first model of
positives against unlabelled: over thresholds, the least ratio of the share of unlabelled to the
share of positives above it, both corrected for their sampling error.

The model is fitted on at most ``SAMPLE`` positives and about as many unlabelled documents, those of
smallest hash of doc_id; every document is scored. Rows whose crc32(doc_id as text) is
a multiple of 5 are held out: neither sample has them. doc_id, lang, source and labels
are inputs of no score.

Nulls: a null text is scored as an empty one; labels of null id or quality are ignored; a null
doc_id counts as held out. Rows with equal doc_id are scored each for itself. Without positives
every score is the prior 0.5. An empty table gives no rows. Other columns pass through
``scored`` untouched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardtables.llm.common import rows_of

SAMPLE = 12_000
FOLDS = 5
THRESHOLD = 0.3
STEPS = 600
RATE = 0.05
DECAY = 1e-4

_ASCII_KINDS = np.zeros(256, dtype=np.int8)  # 1 letters, 2 digits, 3 white space, 4 marks, 5 symbols
_ASCII_KINDS[[*range(65, 91), *range(97, 123)]] = 1
_ASCII_KINDS[48:58] = 2
_ASCII_KINDS[[9, 10, 11, 12, 13, 32]] = 3
_ASCII_KINDS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_ASCII_KINDS[[c for c in range(33, 127) if _ASCII_KINDS[c] == 0]] = 5
_ASCII_KINDS[128:] = 6


def features(text: str | None) -> list[float]:
    """Statistics of one whole text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * N_FEATURES
    kinds = np.bincount(_ASCII_KINDS[np.frombuffer(raw, dtype=np.uint8)], minlength=7) / size
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), dtype=np.uint8)
    twice = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = raw.split(b"\n")
    return [
        1.0,
        *kinds[1:].tolist(),
        float(np.log1p(n)),
        float(lengths.mean()) / 10,
        float(lengths.std()) / 10,
        float(lengths.max() > 40),
        float((lengths == 1).mean()),
        len(counts) / n,
        len(counts) / n**0.8,
        pairs / max(1, n - 1),
        twice / max(1, n - 1),
        max(counts.values()) / n,
        float((_ASCII_KINDS[ends] == 5).mean()),
        float((_ASCII_KINDS[ends] == 4).mean()),
        float(np.log1p(n / len(lines))),
        len(set(lines)) / len(lines),
        raw.count(b"|") / n,
        sum(w[:1].isupper() for w in words) / n,
    ]


N_FEATURES = 23


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learnt."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % FOLDS == 0, F.lit(True))


class Model:
    """Weights of a linear score over standardised statistics and their squares."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> None:
        self.centre, self.scale, self.weights = centre, scale, weights

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.hstack([z, z * z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(x) @ self.weights, -30, 30)))


def _descend(gradient: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Adam with a fixed number of steps."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, STEPS + 1):
        g = gradient(w) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least corrected ratio of the shares above a threshold, over thresholds of the scores."""
    steps = np.quantile(positive, np.linspace(0.02, 0.9, 60))
    p = np.array([(positive >= t).mean() for t in steps])
    u = np.array([(unlabelled >= t).mean() for t in steps])
    slack = np.sqrt(np.log(60) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    return float(np.clip(np.min((u + slack) / np.maximum(p - slack / 2, 0.05)), 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[Model, float]:
    """The model of least non-negative risk, and the class prior it was fitted with."""
    both = np.vstack([positive, unlabelled])
    model = Model(both.mean(0), both.std(0) + 1e-6, np.zeros(2 * both.shape[1] + 1))
    xp, xu = model.inputs(positive), model.inputs(unlabelled)

    def first(w: np.ndarray) -> np.ndarray:
        return -(1 - _sigmoid(xp @ w)) @ xp / len(xp) + _sigmoid(xu @ w) @ xu / len(xu)

    w = _descend(first, xp.shape[1])
    prior = estimate_prior(xp @ w, xu @ w)

    def risk(w: np.ndarray) -> np.ndarray:
        sp, su = xp @ w, xu @ w
        as_one = -(1 - _sigmoid(sp)) @ xp / len(xp)
        p_zero = _sigmoid(sp) @ xp / len(xp)
        u_zero = _sigmoid(su) @ xu / len(xu)
        rest = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        return prior * as_one + (u_zero - prior * p_zero if rest >= 0 else prior * p_zero - u_zero)

    model.weights = _descend(risk, xp.shape[1])
    return model, prior


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on bounded samples; None without a positive or without text."""
    ids = docs.select("doc_id").where(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    trusted = labels.where("quality = 1").select("doc_id").where(~held_out(F.col("doc_id")))
    trusted = trusted.distinct().join(ids.distinct(), "doc_id").orderBy(order, "doc_id").limit(SAMPLE)
    unlabelled = ids.distinct().orderBy(order.bitwiseXOR(F.lit(0x5DEECE66D)), "doc_id").limit(SAMPLE)
    chosen = trusted.withColumn("kind", F.lit(1)).unionByName(unlabelled.withColumn("kind", F.lit(0)))
    chosen = chosen.groupBy("doc_id").agg(F.max("kind").alias("p"), F.min("kind").alias("u"))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    @F.arrow_udf("array<double>")
    def stats(text: pa.Array) -> pa.Array:
        return pa.array([features(t) for t, in rows_of(text)], pa.list_(pa.float64()))

    rows = texts.select("p", "u", stats("text").alias("x")).collect()
    positive = np.array([r.x for r in rows if r.p == 1])
    web = np.array([r.x for r in rows if r.u == 0])
    if not len(positive) or not len(web):
        return None
    return fit(positive, web)[0]


def scored(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """All rows and columns, and the score of the whole text in a column of that name."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(text), 0.5))
        x = np.empty((len(text), N_FEATURES))
        for i, (t,) in enumerate(rows_of(text)):
            x[i] = features(t)
        return pa.array(model.score(x))

    return docs.withColumn(name, score("text"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = scored(docs.select("doc_id", "text"), train(docs, labels))
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
