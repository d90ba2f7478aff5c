"""Operator 12 against exact sums, known spectra and numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from rewardtables.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"


def exact(vectors):
    """(x of every row, n, sums, covariance in double precision) by whole numbers and fractions."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    far = np.array([[n * c - s for c, s in zip(v, sums)] for v in fit], dtype=object)
    products = far.T.dot(far)
    matrix = np.array([[float(Fraction(v, n**3)) for v in row] for row in products.tolist()])
    return x, n, sums, matrix


def check(rows, vectors, ids):
    x, n, sums, matrix = exact(vectors)
    values, vectors_ = np.linalg.eigh(matrix)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    found = {(r.vec_id, r.component): r for r in rows}
    kept = min(16, len(sums))
    assert len(found) == len(rows) == len(ids) * kept
    signs = [None] * kept
    for name, v in zip(ids, x):
        far = [n * c - s for c, s in zip(v, sums)]
        for k in range(kept):
            r = found[name, k + 1]
            assert r.n == n and r.deviation == sum(c * c for c in far)
            want = sum(c / n * u for c, u in zip(far, vectors_[:, k])) / math.sqrt(values[k])
            if signs[k] is None and abs(want) > 1e-3:
                signs[k] = math.copysign(1, want * r.whitened)
            assert abs(r.whitened * (signs[k] or 1) - want) < 1e-8 or signs[k] is None
            assert abs(r.explained - values[k] / values.sum()) < 1e-12
            assert 0 <= r.identity_error < 1e-10


def test_query(spark):
    rows = queries.op12_embedding_whitening(spark, SMALL).collect()
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    check(rows, [r.embedding for r in given], [r.vec_id for r in given])


def frame(spark, rows, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}")
    return df.selectExpr("*", "'z' AS x", "1 AS n", "'y' AS component", "2 AS dims").repartition(3)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = rng.normal(0, 0.4, (40, 3)).tolist()
    rows = [(i, v) for i, v in enumerate(good)] + [(0, good[0]), (99, good[1]), (None, good[2])]
    bad = [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan"), 0.0, 0.0]), (203, [0.0, float("-inf"), 0.0]), (204, [])]
    got = whitening.embedding_whitening(frame(spark, rows + bad, "array<double>")).collect()
    ids = [r[0] for r in rows]
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted(
        (i is None, i or 0, k) for i in ids for k in (1, 2, 3)
    )
    n = len({*map(tuple, exact(good)[0])})
    assert {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-12
    assert whitening.embedding_whitening(frame(spark, [])).collect() == []
    assert whitening.embedding_whitening(frame(spark, bad, "array<double>")).collect() == []


def test_without_variance_and_other_lengths(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [0.1, 0.2, 0.3]), (4, [0.9, 0.2, 0.3])]
    got = {(r.vec_id, r.component): r for r in whitening.embedding_whitening(frame(spark, rows)).collect()}
    assert len(got) == 2 * 2 + 2 * 3
    for i in (1, 2):
        for k in (1, 2):
            r = got[i, k]
            assert (r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None)
    assert sorted(round(got[i, 1].whitened, 12) for i in (3, 4)) == [-1.0, 1.0]
    assert got[3, 1].explained == 1.0 and got[3, 2].whitened is None and got[3, 1].identity_error < 1e-15


def test_large_entries(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [3e12, 5.0])]
    got = whitening.embedding_whitening(frame(spark, rows, "array<double>")).collect()
    assert {r.deviation for r in got if r.vec_id == 1} == {None} and len(got) == 6


@pytest.mark.parametrize("gap", [1e-3, 1e-7, 1e-9, 1e-12, 0.0])
def test_clusters(gap):
    """Known eigenvalues, three of them close together, told apart beyond what float64 finds."""
    rng = np.random.default_rng(9)
    wide = np.longdouble
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0].astype(wide)
    for _ in range(3):  # orthogonal in extended precision
        q = q + q @ (np.eye(12) - q.T @ q) / 2
    gap = wide(gap)
    values = np.array([5, 3, 2 + 2 * gap, 2 + gap, 2, 1, 0.5, 0.25, 0.2, 0.1, 1e-3, 1e-6], dtype=wide)
    a = (q * values) @ q.T
    got, x = whitening.refined(a)
    assert np.abs(got - values).max() < 1e-17
    assert np.abs(x.T @ x - np.eye(12)).max() < 1e-17
    assert np.abs(a @ x - x * got).max() < 1e-16
    for k in (0, 1, 5, 11):
        assert min(np.abs(x[:, k] - q[:, k]).max(), np.abs(x[:, k] + q[:, k]).max()) < 1e-15
    if gap >= 1e-12:
        for k in (2, 3, 4):
            off = min(np.abs(x[:, k] - q[:, k]).max(), np.abs(x[:, k] + q[:, k]).max())
            assert off < 1e-18 / gap + 1e-15


def test_refinement_of_plain_cases():
    for a in (np.zeros((3, 3)), np.eye(4) * 7, np.diag([1e-30, 4.0, 2.0]), np.empty((0, 0)), np.array([[2.5]])):
        value, x = whitening.refined(a)
        assert np.allclose((a @ x).astype(float), (x * value).astype(float)) and np.allclose((x.T @ x).astype(float), np.eye(len(a)))
        assert value.tolist() == sorted(value.tolist(), reverse=True)
