"""Operator 1: near-duplicate embeddings by codebooks of which two must agree.

Every vector has a code, the number of the nearest centre, in each of some ten to thirty codebooks. Two vectors
are compared where two of their codes agree. A codebook's turn brings the vectors of equal code together,
each vector once, and the task compares those that agree in a later codebook too. So what
is shuffled at once is the vectors themselves a few times (``ROUND_BYTES``, or one turn), however many
cells there are. A pair belongs to the first two codebooks in which it agrees, so it is counted once. Codebooks are
added until ``TARGET`` of vectors at exactly the threshold in random directions around a sample, and all
linked pairs within the sample, agree in two. Cosines are products in single precision; those that this
precision cannot tell from the threshold are worked out in double precision.

The codebooks and their number come from at most ``SAMPLE`` vectors, those of smallest
digest; every vector is indexed and compared. Equal vectors are one class. A cell much larger than the others
(``EVEN``) is cut into parts whose pairs are compared in different tasks, so that a cell of any size is
spread. A task returns a count for each vector and a forest that connects what it
found linked, never the pairs.

Nulls: vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
vectors of different length neither. A null vec_id is kept, and names a component only if no
other does. Rows with equal vec_id stay apart by their vectors. An empty table gives no
rows. Other columns, labels too, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from rewardtables.llm.common import components, few_rows, steps
from rewardtables.sources.scratch import staged

THRESHOLD = 0.9
SAMPLE = 16_000
PROBES = 4_000
#: vectors at the threshold around each probe, and components of all these at most
ASIDE = 8
ASIDE_SIZE = 4_000_000
TARGET = 0.9995
#: vectors that agree in two codebooks, about
CELL = 48
CODES = 1024
TURNS = 6
#: codebooks at most
MOST = 48
#: vectors of a part of a cell at least, and times the mean cell
BLOCK = 2048
EVEN = 3.0
#: vectors compared with as many at once; cells up to ``SMALL`` vectors are compared several at a time, ``MANY`` vectors
TILE = 256
SMALL = 96
MANY = 8192
#: codebooks in which pairs of a larger cell are looked at beforehand, and the share of them that are worked out one by one
LOOK = 6
FEW = 0.02
#: what the turns of one round shuffle, if it is more than one turn
ROUND_BYTES = 128 * 2**20
#: vectors packed into one row, and bytes of vectors that a task deals out at once
PACK = 1024
DEAL_BYTES = 16 * 2**20


def unit(values: list[float | None] | None) -> np.ndarray | None:
    """The vector at length 1, or None if it has no direction."""
    if not values or None in values:
        return None
    x = np.asarray(values, dtype=np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    return units(x[None])[0]


def units(x: np.ndarray) -> np.ndarray:
    """Rows at length 1."""
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


_READ = "vec_id long, key binary, raw binary"


def _digests(kind: str):
    """Vectors to the digest of their direction and their components as bytes of this kind."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1024):
            lists = batch.column(1)
            begin = lists.offsets.to_numpy()
            values = lists.values.slice(begin[0], begin[-1] - begin[0])
            lengths = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(begin), 0)
            numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null as NaN
            keys, raws = [None] * len(lists), [None] * len(lists)
            for size in np.unique(lengths[lengths > 0]).tolist():
                at = np.flatnonzero(lengths == size)
                x = numbers[(begin[at] - begin[0])[:, None] + np.arange(size)]
                good = np.isfinite(x).all(1) & x.any(1)
                x = x[good]
                for i, raw, u in zip(at[good].tolist(), x.astype(kind), units(x), strict=True):
                    keys[i], raws[i] = hashlib.blake2b(u.tobytes(), digest_size=16).digest(), raw.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())],
                names=["vec_id", "key", "raw"],
            )

    return digests


def read_units(raw: np.ndarray, kind: str) -> np.ndarray:
    """Unit vectors of rows of bytes."""
    return units(np.ascontiguousarray(raw).view(kind).astype(np.float64))


_KEY = 16
_PACK = "size int, n int, key binary, copies binary, raw binary, codes binary"


class Pack:
    """Vectors of one length: keys, copies, components, codes, a row of each per vector."""

    def __init__(self, size: int, key: np.ndarray, copies: np.ndarray, raw: np.ndarray, codes: np.ndarray) -> None:
        self.size, self.key, self.copies, self.raw, self.codes = size, key, copies, raw, codes

    def __len__(self) -> int:
        return len(self.key)

    @classmethod
    def read(cls, rows: list[dict]) -> Pack:
        """The vectors of rows of one length."""
        size, n = rows[0]["size"], sum(r["n"] for r in rows)
        columns = (np.frombuffer(b"".join(r[c] for r in rows), kind) for c, kind in (("key", "u1"), ("copies", "<i8"), ("raw", "u1"), ("codes", "<i2")))
        return cls(size, *(c.reshape(n, -1) for c in columns))

    def row(self, at: np.ndarray | slice = slice(None)) -> dict:
        columns = {c: getattr(self, c)[at] for c in ("key", "copies", "raw", "codes")}
        return {"size": self.size, "n": len(columns["key"])} | {c: np.ascontiguousarray(v).tobytes() for c, v in columns.items()}


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def arrow(schema: str) -> pa.Schema:
    return pa.schema([(c, _KINDS[kind]) for c, kind in (x.split() for x in schema.split(","))])


def packs(batches: Iterator[pa.RecordBatch], most: int = DEAL_BYTES) -> Iterator[Pack]:
    """Rows of packed vectors, several at once."""
    held: dict[int, list[dict]] = {}
    for batch in batches:
        for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            held.setdefault(row["size"], []).append(row)
            if sum(len(r["raw"]) for rows in held.values() for r in rows) >= most:
                yield from map(Pack.read, held.values())
                held = {}
    yield from map(Pack.read, held.values())


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the centre nearest to each point; ``centres`` may hold several codebooks of equal size."""
    return (points @ centres.swapaxes(-1, -2) - (centres * centres).sum(-1)[..., None, :] / 2).argmax(-1)


def codebook(points: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of cells with about equally many of the points."""
    centres = points[rng.choice(len(points), codes, replace=False)]
    for _ in range(TURNS if codes > 1 else 0):
        code = nearest(points, centres)
        order = np.argsort(code, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) > 0]))
        n = np.diff(np.append(begin, len(order)))
        centres[code[order][begin]] = np.add.reduceat(points[order], begin) / n[:, None].astype(np.float32)
    return centres


class Codebooks:
    """Codebooks for vectors of one length."""

    def __init__(self, sample: np.ndarray, n: int, threshold: float) -> None:
        codes = int(np.clip(np.sqrt(n / CELL), 1, min(CODES, (len(sample) + 1) // 2)))
        self.room = max(BLOCK, int(EVEN * n / codes))
        points = sample.astype(np.float32)
        # centres are nearer to the points that they come from than to others, so these tell nothing about the agreement of others
        own = points if len(points) < 2 * PROBES else points[PROBES:]
        probes = sample[:PROBES]
        rng = np.random.default_rng(3)
        linked = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for at in range(0, len(probes), 500):
            q, x = np.nonzero(points[at : min(at + 500, len(probes))] @ points.T >= threshold)
            q += at
            linked.append((q[q != x], x[q != x]))
        q, x = (np.concatenate(c) for c in zip(*linked, strict=True))
        if len(q) > ASIDE_SIZE:
            q, x = (c[rng.choice(len(q), ASIDE_SIZE, replace=False)] for c in (q, x))
        probes = np.tile(probes, (int(np.clip(ASIDE_SIZE // probes.size, 1, ASIDE)), 1))
        aside = rng.normal(size=probes.shape)
        aside -= (aside * probes).sum(1)[:, None] * probes
        length = np.sqrt((aside**2).sum(1))[:, None]
        aside = np.divide(aside, length, out=np.zeros_like(aside), where=length > 0)
        others = (threshold * probes + np.sqrt(1 - threshold**2) * aside).astype(np.float32)
        at_threshold, in_sample, books = np.zeros(len(probes), np.int64), np.zeros(len(q), np.int64), []
        while len(books) < 2 or (
            len(books) < MOST and ((at_threshold < 2).mean() > 1 - TARGET or (in_sample < 2).any())
        ):
            books.append(codebook(own, codes, rng))
            code = nearest(points, books[-1])
            at_threshold += np.resize(code[:PROBES], len(others)) == nearest(others, books[-1])
            in_sample += code[q] == code[x]
        self.centres = np.array(books)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """A row per vector, a column per codebook."""
        x = x.astype(np.float32)
        return np.concatenate([nearest(x[at : at + 256], self.centres) for at in range(0, len(x), 256)], axis=1).T


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest reachable column of every linked row and column; -1 where nothing is linked."""
    rows, cols = np.nonzero(linked)
    by_col = np.argsort(cols, kind="stable")
    row_of, row_at = np.unique(rows, return_index=True)
    col_of, col_at = np.unique(cols[by_col], return_index=True)
    of_row = np.full(linked.shape[0], -1)
    of_col = np.full(linked.shape[1], -1)
    of_col[col_of] = col_of
    while len(rows):
        of_row[row_of] = np.minimum.reduceat(of_col[cols], row_at)
        least = np.minimum.reduceat(of_row[rows[by_col]], col_at)
        if (least == of_col[col_of]).all():
            break
        of_col[col_of] = least
    return of_row, of_col


def connect(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least reachable number of each, ``low`` being that before the links of a and b."""
    while len(a):
        la, lb = low[a], low[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(low, np.maximum(la, lb), np.minimum(la, lb))
        while (low[low] != low).any():
            low = low[low]
    return low


class Links:
    """Counts of the links of some vectors, and the least vector that each is connected with."""

    def __init__(self, copies: np.ndarray) -> None:
        self.copies, self.counts, self.low = copies, np.zeros(len(copies)), np.arange(len(copies))
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.waiting += len(a)
        if self.waiting > 1_000_000:
            self.settle()

    def settle(self) -> None:
        if self.held:
            a, b = (np.concatenate(c) for c in zip(*self.held, strict=True))
            for x, y in ((a, b), (b, a)):
                self.counts += np.bincount(x, weights=self.copies[y], minlength=len(self.low))
            self.low = connect(self.low, a, b)
        self.held, self.waiting = [], 0


class Comparison:
    """Links among packed vectors of a cell of one codebook, those that agree in no other codebook before the second."""

    def __init__(self, here: Pack, turn: int, threshold: float, kind: str) -> None:
        self.here, self.turn, self.threshold, self.kind = here, turn, threshold, kind
        # the last row stands for none
        self.x = np.pad(read_units(here.raw, kind).astype(np.float32), ((0, 1), (0, 0)))
        #: products of single precision are as near to the cosine at least
        self.error = (self.x.shape[1] + 4) * 2.0**-22
        self.links = Links(here.copies[:, 0])
        self.codes = np.ascontiguousarray(here.codes.T)

    def exact(self, at: np.ndarray) -> np.ndarray:
        return read_units(self.here.raw[at], self.kind)

    def add(self, a: np.ndarray, b: np.ndarray, cosine: np.ndarray, second: int) -> None:
        """Pairs that single precision finds linked."""
        for before in range(second):
            if before != self.turn and len(a):
                other = self.codes[before, a] != self.codes[before, b]
                a, b, cosine = a[other], b[other], cosine[other]
        unsure = np.flatnonzero(cosine < self.threshold + self.error)
        if len(unsure):
            kept = np.ones(len(a), dtype=bool)
            for i in range(0, len(unsure), 4096):
                part = unsure[i : i + 4096]
                kept[part] = (self.exact(a[part]) * self.exact(b[part])).sum(1) >= self.threshold
            a, b = a[kept], b[kept]
        if len(a):
            self.links.add(a, b)

    def sides(self, at: np.ndarray, to: np.ndarray, second: int) -> None:
        """The vectors ``at`` with those of ``to``, or among them if these are the same."""
        for i in range(0, len(at), TILE):
            x, a = self.x[at[i : i + TILE]], at[i : i + TILE]
            for j in range(i if at is to else 0, len(to), TILE):
                b = to[j : j + TILE]
                new = self.new(a, b, second)
                if at is to and i == j:
                    new = np.tri(len(a), k=-1, dtype=bool).T & new
                if np.count_nonzero(new) < FEW * new.size:
                    hit = np.flatnonzero(new)
                    pair = a[hit // len(b)], b[hit % len(b)]
                    cosine = np.einsum("ij,ij->i", self.x[pair[0]], self.x[pair[1]])
                else:
                    cosine = (x @ self.x[b].T).reshape(-1)
                    hit = np.flatnonzero((cosine >= self.threshold - self.error) & new.reshape(-1))
                    pair, cosine = (a[hit // len(b)], b[hit % len(b)]), cosine[hit]
                near = cosine >= self.threshold - self.error
                if near.any():
                    self.add(pair[0][near], pair[1][near], cosine[near], second)

    def new(self, a: np.ndarray, b: np.ndarray, second: int) -> np.ndarray:
        """Pairs that agree in none of the first codebooks before the second, but in this one: near copies agree in most."""
        new = np.ones((len(a), len(b)), dtype=bool)
        for before in [x for x in range(second) if x != self.turn][:LOOK]:
            new &= self.codes[before, a][:, None] != self.codes[before, b]
            if np.count_nonzero(new) < FEW * new.size:
                break
        return new

    def small(self, order: np.ndarray, begin: np.ndarray, n: np.ndarray, second: int) -> np.ndarray:
        """Among the vectors of each small cell: n each of ``order`` from ``begin``. The other cells are told."""
        for width in range(8, SMALL + 1, 8):
            cells = np.flatnonzero((n > max(1, width - 8)) & (n <= width))
            for i in range(0, len(cells), MANY // width):
                part = cells[i : i + MANY // width]
                slot = np.arange(width)
                at = np.where(slot < n[part][:, None], order[np.minimum(begin[part][:, None] + slot, len(order) - 1)], len(order))
                x = self.x[at]
                z = (x @ x.copy().swapaxes(1, 2)).reshape(-1)
                hit = np.flatnonzero(z >= self.threshold - self.error)
                cell, hit_in = np.divmod(hit, width * width)
                a, b = np.divmod(hit_in, width)
                ahead = (a < b) & (b < n[part][cell])
                cell, a, b = cell[ahead], a[ahead], b[ahead]
                self.add(at[cell, a], at[cell, b], z[hit[ahead]], second)
        return n > SMALL


def _compare(threshold: float, kind: str = "<f8"):
    kinds = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("near", pa.binary())])

    def compare(block: pa.Table) -> pa.Table:
        rows = [r for i in range(len(block)) for r in block.slice(i, 1).to_pylist()]
        one, other, turn = (rows[0][c] for c in ("one", "other", "turn"))
        left = np.repeat([r["own"] == one for r in rows], [r["n"] for r in rows])
        here = Pack.read(rows)
        if len(here) < 2:
            return kinds.empty_table()
        del rows, block
        pairs = Comparison(here, turn, threshold, kind)
        links = pairs.links
        for second in range(turn + 1, here.codes.shape[1]):
            code = here.codes[:, second]
            order = np.argsort(code, kind="stable")
            begin = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) > 0]))
            n = np.diff(np.append(begin, len(order)))
            large = pairs.small(order, begin, n, second) if one == other else np.ones(len(n), dtype=bool)
            for at, many in zip(begin[large], n[large], strict=True):
                cell = order[at : at + many]
                if one == other:
                    pairs.sides(cell, cell, second)
                else:
                    pairs.sides(cell[left[cell]], cell[~left[cell]], second)
        links.settle()
        found = np.flatnonzero(links.counts > 0)
        keys = [here.key[at].tobytes() for at in (found, links.low[found])]
        names = [[k[i : i + _KEY] for i in range(0, len(k), _KEY)] for k in keys]
        return pa.Table.from_arrays(
            [pa.array(names[0], pa.binary()), pa.array(links.counts[found].astype(np.int64)), pa.array(names[1], pa.binary())],
            schema=kinds,
        )

    return compare


_DEALT = "turn int, cell int, one int, other int, own int, " + _PACK


def _deal(turns: range, parts: dict[tuple[int, int, int], int]):
    """Packed vectors by the cells of some turns; those of a cell in parts go to each pair of parts with their own."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in packs(batches):
            place = np.ascontiguousarray(pack.key[:, :8]).view("<u8")[:, 0]
            rows = []
            for turn in turns[: max(0, pack.codes.shape[1] - 1 - turns.start)]:
                code = pack.codes[:, turn]
                order = np.argsort(code, kind="stable")
                for at in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
                    cell = int(code[at[0]])
                    n = parts.get((pack.size, turn, cell), 1)
                    part = (place[at] % np.uint64(n)).astype(np.int64)
                    for own in np.unique(part).tolist():
                        row = {"turn": turn, "cell": cell, "own": own} | pack.row(at[part == own])
                        rows += [row | {"one": min(own, i), "other": max(own, i)} for i in range(n)]
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[i : i + 64], schema=arrow(_DEALT))

    return deal


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, key), and for classes of vectors: key, links, near (a part of a forest)."""
    kind = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "<f8"
    read = vectors.select("vec_id", "embedding").mapInArrow(_digests(kind), _READ)
    base = staged(read.select("vec_id", "key", F.length("raw").alias("size")), "vectors")
    known = base.where("key is not null")
    sizes = {r[0]: r[1] for r in known.select("key", "size").distinct().groupBy("size").count().orderBy(F.desc("count")).limit(16).collect()}
    least = F.broadcast(known.select("key").distinct().orderBy("key").limit(SAMPLE))
    ids = known.join(least, "key", "left_semi").groupBy("key").agg(F.min("vec_id").alias("wanted")).select("wanted").distinct()
    wanted = vectors.join(F.broadcast(ids), F.col("vec_id").eqNullSafe(F.col("wanted")), "left_semi")
    wanted = wanted.select("vec_id", "embedding").mapInArrow(_digests(kind), _READ).join(least, "key", "left_semi")
    sample: dict[int, list[bytes]] = {size: [] for size in sizes}
    for _, raw in sorted(wanted.where(F.length("raw").isin(*sizes, 0)).groupBy("key").agg(F.first("raw")).collect()):
        sample[len(raw)].append(raw)
    books = {
        size: Codebooks(read_units(np.frombuffer(b"".join(raws), "u1").reshape(len(raws), -1), kind), sizes[size], threshold)
        for size, raws in sample.items()
        if len(raws) > 1
    }

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, PACK):
            keys, copies, raws = (batch.column(c).to_pylist() for c in ("key", "copies", "raw"))
            rows = []
            for size in {len(r) for r in raws}:
                at = [i for i, r in enumerate(raws) if len(r) == size]
                key, raw = (np.frombuffer(b"".join(c[i] for i in at), "u1").reshape(len(at), -1) for c in (keys, raws))
                if size in books:
                    codes = books[size].codes(read_units(raw, kind))
                else:  # lengths outside the sample: one cell for all
                    codes = np.zeros((len(at), 2))
                rows.append(Pack(size, key, np.array([copies[i] for i in at], "<i8"), raw, codes.astype("<i2")).row())
            yield pa.RecordBatch.from_pylist(rows, schema=arrow(_PACK))

    classes = read.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.first("raw").alias("raw"))
    indexed = staged(classes.mapInArrow(index, _PACK), "indexed-vectors")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["codes"], "<i2").reshape(row["n"], -1)
                for turn in range(codes.shape[1] - 1):
                    n = held.setdefault((row["size"], turn), np.zeros(CODES, np.int64))
                    n += np.bincount(codes[:, turn], minlength=CODES)
        for (size, turn), n in held.items():
            cell = np.flatnonzero(n)
            columns = np.full(len(cell), size), np.full(len(cell), turn), cell, n[cell]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["size", "turn", "cell", "held"])

    room = F.lit(BLOCK)
    for size, b in books.items():
        room = F.when(F.col("size") == size, b.room).otherwise(room)
    counts = indexed.select("size", "n", "codes").mapInArrow(count, "size long, turn long, cell long, held long")
    counts = counts.groupBy("size", "turn", "cell").agg(F.sum("held").alias("held")).where(F.col("held") > room)
    parts = {(r.size, r.turn, r.cell): r.parts for r in counts.withColumn("parts", F.ceil(F.col("held") / room)).collect()}
    turns = max([2, *(len(b.centres) for b in books.values())]) - 1
    at_once = max(1, ROUND_BYTES // max(1, sum((size + 64) * n for size, n in sizes.items())))
    found = []
    for begin in range(0, turns, at_once):
        dealt = indexed.mapInArrow(_deal(range(begin, begin + at_once), parts), _DEALT)
        links = dealt.groupBy("size", "turn", "cell", "one", "other").applyInArrow(
            _compare(threshold, kind), "key binary, links long, near binary"
        )
        found.append(staged(links, "vector-links"))
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    return base.select("vec_id", "key"), every


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    base, found = embedding_links(vectors, threshold)
    part = components(found.select(F.col("key").alias("a"), F.col("near").alias("b")))
    classes = base.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    classes = (
        classes.join(found.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
        .join(part.withColumnsRenamed({"id": "key"}), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    alone = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        base.select("vec_id", "key")
        .join(named, "key", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), alone.alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
