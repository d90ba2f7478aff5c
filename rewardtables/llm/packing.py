"""Operator 2: best-fit packing in bulk-synchronous sweeps.

Pieces (documents, or cuts of longer ones) are range-sorted by length and ranked within
their length across partitions. Pieces of one length and gaps of one size form runs, so
a state of at most ``capacity`` lengths and some thousand runs of gaps stands for any
number of documents. In every sweep the sizes go down from the largest: gaps come in, and pieces
of a length take the smallest gaps that came in before, each gap one piece at most; where more
pieces want a gap than there are, those of lower rank have it. When a sweep is over,
all gaps shrink together and the next sweep begins. Every sweep is sent to the pieces as
intervals of ranks, which they look up where they are.

A sequence is opened only for pieces that fit no gap, neither as it was before the sweep nor
as the sweep leaves it, and only as many as pieces of that length fill. Runs double as often as sweeps happen at most and sweeps end after ``capacity``
rounds, whatever the number of rows; in practice there are some dozens. The sweeps
themselves are one loop on the driver over counts by length (``sweep_runs``); Spark ranks the
pieces before and looks them up after. No bound on the number of runs is proven.

Nulls: a null text is empty, its piece is the end id. Rows with equal doc_id are packed
each for itself. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.llm.common import TEXTS_PER_STEP
from rewardtables.llm.encoding import WordEncoder, tokenizer_path
from rewardtables.sources.scratch import staged

CAPACITY = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    """Token counts and checksums of all documents, longer ones cut at the capacity."""
    tokenizer = tokenizer or tokenizer_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordEncoder.of(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_PER_STEP):
                rows = batch.slice(at, TEXTS_PER_STEP)
                coded = coder.encode_many(rows.column(1).to_pylist(), end_id)
                out = [
                    (name, n, first, len(part := ids[first : first + capacity]), zlib.crc32(part))
                    for name, ids in zip(rows.column(0).to_pylist(), coded, strict=True)
                    for n, first in enumerate(range(0, len(ids), capacity))
                ]
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(encode, PIECES)


def sweep_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit sweeps over runs: (length, first rank, how many, first sequence, offset).

    ``counts`` has the number of pieces of every length.
    """
    left = {length: n for length, n in counts.items() if n}
    placed = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # size: first sequence, count
    opened, out = 0, []
    while left:
        stack: list[tuple[int, int, int]] = []
        taken: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for size in sorted({*left, *gaps}, reverse=True):
            stack.extend((size, first, n) for first, n in gaps.get(size, ()))
            want = left.get(size, 0)
            while want and (stack or size > max(taken, default=0)):
                if not stack:
                    fresh = -(-want // (capacity // size))
                    stack.append((capacity, opened, fresh))
                    opened += fresh
                gap, first, n = stack.pop()
                fit = min(n, want)
                out.append((size, placed[size], fit, first, capacity - gap))
                placed[size] += fit
                want -= fit
                if gap > size:
                    taken[gap - size].append((first, fit))
                if fit < n:
                    stack.append((gap, first + fit, n - fit))
                if gap == capacity:
                    break  # the new sequences take more of this length in the next sweeps
            left[size] = want
        left = {length: n for length, n in left.items() if n}
        for gap, first, n in stack:
            taken[gap].append((first, n))
        gaps = taken
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a sequence_id and a gapless offset in it.

    ``pieces`` has doc_id, piece and a length of 1 to ``capacity``; other columns pass through.
    """
    columns = pieces.columns
    ordered = pieces.repartitionByRange(F.col("length").desc(), "doc_id", "piece")
    ordered = ordered.sortWithinPartitions(F.col("length").desc(), "doc_id", "piece")
    schema = f"{_ddl(ordered)}, part int, rank long"

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            lengths = batch.column(columns.index("length")).to_numpy(zero_copy_only=False)
            ranks = np.empty(len(lengths), dtype=np.int64)
            edges = np.flatnonzero(np.diff(lengths)) + 1
            for a, b in zip([0, *edges], [*edges, len(lengths)], strict=True):
                if a < b:
                    length = int(lengths[a])
                    ranks[a:b] = np.arange(seen[length], seen[length] + b - a)
                    seen[length] += b - a
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(len(lengths), part), pa.int32()),
                    pa.array(ranks, pa.int64()),
                ],
                names=[*columns, "part", "rank"],
            )

    ranked = staged(ordered.mapInArrow(rank, schema), "ranked-pieces")
    # sorted ranges: a row for every length, and one more for every cut between partitions
    shares = ranked.groupBy("length", "part").agg(F.count("*").alias("n")).collect()
    counts: dict[int, int] = defaultdict(int)
    base: dict[tuple[int, int], int] = {}
    for length, part, n in sorted(shares):
        base[length, part] = counts[length]
        counts[length] += n
    runs = np.array(sweep_runs(counts, capacity), dtype=np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    span = max(counts.values(), default=0) + 1
    keys = runs[:, 0] * span + runs[:, 1]
    sent = ranked.sparkSession.sparkContext.broadcast((keys, runs, base))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, runs, base = sent.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            part = batch.column("part").to_numpy(zero_copy_only=False)
            before = np.array(
                [base[x] for x in zip(length.tolist(), part.tolist(), strict=True)], dtype=np.int64
            )
            number = batch.column("rank").to_numpy(zero_copy_only=False) + before
            at = np.searchsorted(keys, length * span + number, side="right") - 1
            run = runs[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(run[:, 3] + number - run[:, 1], pa.int64()),
                    pa.array(run[:, 4], pa.int64()),
                ],
                names=[*columns, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{_ddl(pieces)}, sequence_id long, offset long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    """Tokenise, cut and pack all documents: a row per piece with its sequence and offset."""
    pieces = staged(cut_pieces(docs, tokenizer, end_id, capacity), "pieces")
    return pack(pieces, capacity)
