"""Operator 8: token ids in directly addressable codes.

A block holds the ids of some whole documents. An id is split into chunks of eight bits.
Level 0 has the lowest chunk of every id; a bitmap says which ids go on, and level 1 has
the next chunk of those only, and so on. A rank directory has the number of set bits before
every 512th bit, so that the place of any id's next chunk is found without decoding
what lies before: ``Codes.get(i)`` reads one byte a level.

The files are Parquet rows ``(part, block, part_start, doc_ids, n_tokens, codes)`` in ascending
order of documents; a block holds whole documents, one at least.

Nulls: a text of null is empty (its ids are the end id alone); a null doc_id sorts first.
Rows with equal doc_id stay apart, in order of their texts. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.llm.common import TEXTS_PER_STEP
from rewardtables.llm.encoding import WordEncoder, tokenizer_path
from rewardtables.sources.scratch import scratch_dir

BLOCK_IDS = 1 << 18
RANK_BITS = 512
MAGIC = b"DAC1"


def encode_codes(ids: np.ndarray) -> bytes:
    """Levels of eight-bit chunks, each with its bitmap and rank directory."""
    rest = np.asarray(ids, dtype=np.uint32)
    levels = []
    while True:
        chunk = (rest & 255).astype(np.uint8)
        more = rest > 255
        if not more.any():
            levels.append((chunk, b"", b""))
            break
        bits = np.packbits(more, bitorder="little")
        before = np.cumsum(more)[RANK_BITS - 1 :: RANK_BITS]
        ranks = np.concatenate([[0], before]).astype("<u4")
        levels.append((chunk, bits.tobytes(), ranks.tobytes()))
        rest = rest[more] >> 8
    head = [MAGIC, struct.pack("<II", len(levels), len(ids))]
    for chunk, bits, ranks in levels:
        head.append(struct.pack("<III", len(chunk), len(bits), len(ranks)))
    return b"".join(head + [x for c, bits, ranks in levels for x in (c.tobytes(), bits, ranks)])


class Codes:
    """Random access to the ids of one block."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        n_levels, self.n = struct.unpack_from("<II", raw, 4)
        at = 12 + 12 * n_levels
        self._levels = []
        for level in range(n_levels):
            sizes = struct.unpack_from("<III", raw, 12 + 12 * level)
            parts = []
            for size, kind in zip(sizes, (np.uint8, np.uint8, "<u4"), strict=True):
                parts.append(np.frombuffer(raw[at : at + size], dtype=kind))
                at += size
            self._levels.append(parts)

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before bit i."""
        block = i // RANK_BITS
        first = block * RANK_BITS // 8
        count = int(ranks[block]) + int(np.bitwise_count(bits[first : i // 8]).sum())
        if i % 8:
            count += (int(bits[i // 8]) & ((1 << (i % 8)) - 1)).bit_count()
        return count

    def get(self, i: int) -> int:
        """Id number i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunk, bits, ranks) in enumerate(self._levels):
            value |= int(chunk[i]) << (8 * level)
            if not len(bits) or not bits[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(bits, ranks, i)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop, reading the chunks of these ids only."""
        out = np.zeros(stop - start, dtype=np.uint32)
        where = np.arange(stop - start)
        for level, (chunk, bits, ranks) in enumerate(self._levels):
            out[where] |= chunk[start:stop].astype(np.uint32) << np.uint32(8 * level)
            if not len(bits) or start == stop:
                break
            byte = bits[start // 8 : (stop + 7) // 8]
            more = np.unpackbits(byte, bitorder="little")[start % 8 : start % 8 + stop - start]
            where = where[more.astype(bool)]
            start = self._rank(bits, ranks, start)
            stop = start + len(where)
        return out


BLOCKS = (
    "part int, block int, part_start long, doc_ids array<long>, n_tokens array<long>, codes binary"
)


def write_blocks(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS
) -> None:
    """Encode all documents and write their blocks in ascending order of doc_id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordEncoder.of(tokenizer)
        part = TaskContext.get().partitionId()
        block, begun, names, ids, held = 0, 0, [], [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "part_start": pa.array([begun], pa.int64()),
                    "doc_ids": pa.array([names], pa.list_(pa.int64())),
                    "n_tokens": pa.array([[len(x) for x in ids]], pa.list_(pa.int64())),
                    "codes": pa.array([encode_codes(np.concatenate(ids))], pa.binary()),
                }
            )

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_PER_STEP):
                rows = batch.slice(at, TEXTS_PER_STEP)
                coded = coder.encode_many(rows.column(1).to_pylist(), end_id)
                for name, code in zip(rows.column(0).to_pylist(), coded, strict=True):
                    if ids and held + len(code) > block_ids:
                        yield packed()
                        block, begun, names, ids, held = block + 1, begun + held, [], [], 0
                    names.append(name)
                    ids.append(code)
                    held += len(code)
        if ids:
            yield packed()

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(encode, BLOCKS).write.parquet(path)


def read_documents(blocks: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    Ids before a part are summed from one number per part, as many as the write had tasks.
    """
    totals = (
        blocks.groupBy("part")
        .agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n"))
        .orderBy("part")
        .collect()
    )
    before, base = {}, 0
    for part, n in totals:
        before[part] = base
        base += n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["codes"])
                stops = np.cumsum([0, *row["n_tokens"]])
                first = before[row["part"]] + row["part_start"]
                crcs = [
                    zlib.crc32(codes.slice(a, b).astype("<u4").tobytes())
                    for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "start": pa.array(first + stops[:-1], pa.int64()),
                        "n_tokens": pa.array(row["n_tokens"], pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_codes(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, path: str | None = None
) -> DataFrame:
    """Write the token files of all documents, read them back, one row per document."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "token-codes")
    write_blocks(docs, path, tokenizer or tokenizer_path(), end_id)
    return read_documents(spark.read.parquet(path))
