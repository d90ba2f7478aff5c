"""Operator 12: embedding whitening by mixed-precision refinement of eigenvectors.

Entries c become whole numbers x = floor(64 c) + 1000000; the model is fitted on every distinct x vector
once. Spark tasks sum the vectors exactly, then the products of the centred entries, each task its own part before
anything is shuffled; the driver sees one matrix of dims x dims. Its eigenvectors are found in float32 and
corrected by Ogita and Aishima's iteration in extended precision: with R = I - X'X, S = X'AX and the
quotients l, X goes to X + XE, E = (S + lR) / (l_j - l_i), where errors square from round to round. Where
eigenvalues lie closer than the error of a round, that formula cannot tell their vectors apart: their
space is right, and a sub-solve of A - mI projected on it turns the vectors within.

Vectors of different lengths are fitted apart, one model per length. Nulls: rows whose vector is null or holds null
or non-finite entries are dropped; a null vec_id is kept. Repeated rows are each told, and fitted once. Empty vectors
have no components. Entries beyond 2**56 count as that. A component without variance (all vectors equal, or fewer
than there are dimensions) has whitened NULL and stays out of identity_error, which is NULL if none is
left; explained is NULL where the trace is 0; a deviation that no long holds is NULL. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardtables.sources.scratch import staged

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: rows whose products are summed at once; sums of such blocks are added in extended precision
BLOCK = 1_024
ROUNDS = 30
LARGEST = float(2**62)


def scaled(vector: Column) -> Column:
    """The whole numbers of a vector."""
    entry = lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.lit(float(SCALE)) * c.cast("double")))
    return F.transform(vector, lambda c: F.floor(entry(c)) + F.lit(SHIFT).cast("long"))


def usable(vectors: DataFrame) -> DataFrame:
    """Columns vec_id and x of the rows whose vector has finite entries only."""
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    sound = F.col("embedding").isNotNull() & ~F.exists("embedding", odd)
    return vectors.where(sound).select("vec_id", scaled(F.col("embedding")).alias("x"))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as a matrix) for every length in a batch of lists without nulls."""
    stops = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(stops)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, values[stops[rows][:, None] + np.arange(size)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: 64-bit numbers where they suffice, else Python's."""
    reach = max(int(np.abs(x).max(initial=0)), max(map(abs, sums), default=0) // max(n, 1) + 1)
    wide = np.int64 if 2 * n * reach < 2**62 else object
    return n * x.astype(wide) - np.array(sums, dtype=wide)


def exact_sums(fit_list: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number and sums of the vectors of every length."""
    whole = pa.decimal128(38, 0)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for rows, x in _matrices(batch.column(0)):
                # halves, so that no sum overflows
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                total = high.astype(object) * 2**32 + low.astype(object)
                n, before = held.get(x.shape[1], (0, 0))
                held[x.shape[1]] = n + len(rows), before + total
        for size, (n, total) in held.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "dims": pa.array([size] * (size + 1), pa.int32()),
                    "i": pa.array([-1, *range(size)], pa.int32()),
                    "s": pa.array([n, *total.tolist()], whole),
                }
            )

    parts = fit_list.mapInArrow(part, "dims int, i int, s decimal(38,0)")
    found: dict[int, dict[int, int]] = {}
    for dims, i, s in parts.groupBy("dims", "i").agg(F.sum("s")).collect():
        found.setdefault(dims, {})[i] = int(s)
    return {d: (s[-1], [s[i] for i in range(d)]) for d, s in sorted(found.items())}


def summed_products(fit_list: DataFrame, kept: dict[int, int], rows_of) -> dict[int, np.ndarray]:
    """For every length the sums of products of the columns of ``rows_of(x)``, and of the columns (last row).

    ``kept`` says how many columns a length has; each task adds up its own rows first.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                dims = x.shape[1]
                if not kept.get(dims):
                    continue
                total = held.setdefault(dims, np.zeros((kept[dims] + 1, kept[dims]), dtype=np.longdouble))
                for at in range(0, len(x), BLOCK):
                    c = rows_of(x[at : at + BLOCK])
                    total += np.vstack([c.T @ c, c.sum(axis=0)])
        for dims, total in held.items():
            i, j = np.divmod(np.arange(total.size), total.shape[1])
            yield pa.RecordBatch.from_pydict(
                {
                    "dims": pa.array(np.full(total.size, dims), pa.int32()),
                    "i": pa.array(i, pa.int32()),
                    "j": pa.array(j, pa.int32()),
                    "v": pa.array(total.astype(np.float64).ravel(), pa.float64()),
                }
            )

    parts = fit_list.mapInArrow(part, "dims int, i int, j int, v double")
    found = {d: np.zeros((k + 1, k)) for d, k in kept.items()}
    for dims, i, j, v in parts.groupBy("dims", "i", "j").agg(F.sum("v")).collect():
        found[dims][i, j] = v
    return found


def refined(matrix: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix, in extended precision."""
    wide = np.longdouble
    a = matrix.astype(wide)
    a = (a + a.T) / 2
    size = len(a)
    scale = np.abs(a).max(initial=0)
    if size == 0 or scale == 0:
        return np.zeros(size, dtype=wide), np.eye(size, dtype=wide)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(wide)
    norm, one = np.sqrt((a * a).sum()), np.eye(size, dtype=wide)
    unit, best, found = np.finfo(wide).eps, np.inf, x
    for _ in range(rounds):
        r, s = one - x.T @ x, x.T @ a @ x
        # rounding must not part the halves, or quotients by small gaps leave the unit vectors askew
        r, s = (r + r.T) / 2, (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        close = 2 * (np.sqrt(((s - np.diag(value)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        if close < best:
            best, found = close, x
        if close <= 8 * size * unit * norm:  # as far as rounding lets it come
            break
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > close
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        # values that a round cannot tell apart: turn their vectors within the space they span
        order = np.argsort(-value, kind="stable")
        x, value = x[:, order], value[order]
        for group in np.split(np.arange(size), np.flatnonzero(value[:-1] - value[1:] > close) + 1):
            if len(group) > 1:
                space = x[:, group]
                own = space.T @ (a @ space - value[group].mean() * space)
                width = np.abs(own).max()
                if width > 4 * size * unit:
                    turn = np.linalg.eigh(((own + own.T) / (2 * width)).astype(np.float64))[1][:, ::-1].astype(wide)
                    turn = turn + turn @ (np.eye(len(group), dtype=wide) - turn.T @ turn) / 2
                    x[:, group] = space @ turn
    x = found / np.sqrt((found * found).sum(axis=0))
    value = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-value, kind="stable")
    x, value = x[:, order], value[order]
    # of the two signs the one whose largest entry is positive
    largest = np.abs(x.astype(np.float64)).argmax(axis=0)
    x = x * np.where(x[largest, np.arange(size)] < 0, -1, 1)
    return value * scale, x


@dataclass
class Whitening:
    """A fitted model of vectors of one length."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray  # eigenvalues of the kept components, falling
    vectors: np.ndarray  # their unit vectors as columns
    residue: np.ndarray  # mean of the centred entries, nought but for rounding
    identity_error: float | None = None

    def steady(self) -> np.ndarray:
        """Which components have variance."""
        return self.values > len(self.sums) * np.finfo(np.float64).eps * max(self.trace, 0.0)

    def entries(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return (centred(x, self.n, self.sums) / self.n).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of the components; NaN without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.where(self.steady(), np.sqrt(np.maximum(self.values, 0)), np.nan)
            return self.entries(x) @ self.vectors / root


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Models by length of the vectors in column x, each of which counts once."""
    sums = exact_sums(fit_list)
    plain = {d: Whitening(n, s, 0.0, np.empty(0), np.empty((d, 0)), np.zeros(d)) for d, (n, s) in sums.items()}
    products = summed_products(fit_list, {d: d for d in plain}, lambda x: plain[x.shape[1]].entries(x))
    models: dict[int, Whitening] = {}
    for dims, (n, s) in sums.items():
        matrix = products[dims][:-1] / n
        value, vectors = refined(matrix)
        kept = min(components, dims)
        residue = products[dims][-1] / n
        models[dims] = Whitening(
            n, s, float(np.trace(matrix)), value[:kept].astype(np.float64), vectors[:, :kept].astype(np.float64), residue
        )
    steady = {d: m.steady() for d, m in models.items()}

    def of_steady(x: np.ndarray) -> np.ndarray:
        model, found = models[x.shape[1]], steady[x.shape[1]]
        mean = model.residue @ model.vectors[:, found] / np.sqrt(model.values[found])
        return model.whitened(x)[:, found] - mean

    again = summed_products(fit_list, {d: int(f.sum()) for d, f in steady.items()}, of_steady)
    for dims, model in models.items():
        if steady[dims].any():
            model.identity_error = float(np.abs(again[dims][:-1] / model.n - np.eye(int(steady[dims].sum()))).max())
    return models


_WHITENED = (
    "vec_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
)


def whiten(rows: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """Rows (vec_id, x) to vec_id, n, deviation, whitened, explained, identity_error; arrays by component."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = [()] * batch.num_rows
            for at, x in _matrices(batch.column(1)):
                model = models[x.shape[1]]
                far = centred(x, model.n, model.sums)
                reach = int(np.abs(far).max(initial=0))
                far = far if reach * reach * max(1, x.shape[1]) < 2**63 else far.astype(object)
                deviation = (far * far).sum(axis=1).tolist()
                values = model.whitened(x)
                explained = (model.values / model.trace).tolist() if model.trace > 0 else [None] * len(model.values)
                for row, d, w in zip(at.tolist(), deviation, values.tolist(), strict=True):
                    w = [None if v != v else v for v in w]
                    out[row] = (model.n, d if d < 2**63 else None, w, explained, model.identity_error)
            n, deviation, w, explained, error = zip(*out, strict=True) if out else ((),) * 5
            reals = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(deviation, pa.int64()),
                    pa.array(w, reals),
                    pa.array(explained, reals),
                    pa.array(error, pa.float64()),
                ],
                names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(told, _WHITENED.format(kind=kind))


def embedding_whitening(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = usable(vectors)
    # each fitted vector is written once and read by three passes
    models = fit(staged(rows.select("x").distinct(), "fit-list"), components)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c")
    return whiten(rows, models).select("*", each).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )
