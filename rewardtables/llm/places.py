"""Places of keys that several documents hold, for any key function of a text.

Texts are scanned once; a task keeps the (key, document, place) entries of ``TASK_KEYS`` keys and
sorts them. A key that two of its documents hold is known to be shared: its places
are told, and one entry stands for them all; other keys are sent with all places, which one document
has. So a key held by any number of documents costs its bucket an entry per task. Entries travel
packed by bucket, 32 bits of the key each; a bucket has about ``BUCKET_KEYS`` entries. Keys that agree
in bucket and bits by chance count as shared; callers compare texts anyway.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TASK_KEYS = 400_000
BUCKET_KEYS = 250_000

#: texts to (index of the text, key, place), keys being well mixed 64-bit numbers
KeysOf = Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _planes(values: np.ndarray) -> bytes:
    """Differences of whole numbers, byte by byte, so that they compress."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    folded = ((steps << 1) ^ (steps >> 63)).astype("<u8")  # small for small steps of either sign
    width = max(1, (int(folded.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + folded.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unplanes(raw: bytes, n: int) -> np.ndarray:
    width = raw[0]
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(raw, dtype=np.uint8, offset=1).reshape(width, n).T
    folded = wide.reshape(-1).view("<u8")
    steps = (folded >> np.uint64(1)).astype(np.int64) ^ -(folded & np.uint64(1)).astype(np.int64)
    return np.cumsum(steps)


_SENT = pa.schema(
    [
        ("bucket", pa.int64()),
        ("known", pa.bool_()),
        ("n", pa.int32()),
        ("keys", pa.binary()),
        ("many", pa.binary()),
        ("doc", pa.binary()),
        ("nth", pa.binary()),
        ("place", pa.binary()),
    ]
)
_TOLD = pa.schema([("doc_id", pa.int64()), ("nth", pa.int32()), ("place", pa.int32()), ("key", pa.int64())])


def _packed(bucket, key, many, doc, nth, place, known) -> list[dict]:
    """One row per bucket; entries in order of documents and places."""
    order = np.lexsort((place, doc, bucket))
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    rows = []
    for part in np.split(order, cuts) if len(order) else []:
        rows.append(
            {
                "bucket": int(bucket[len(rows) and cuts[len(rows) - 1]]),
                "known": known,
                "n": len(part),
                "keys": key[part].astype("<u4").tobytes(),
                "many": np.packbits(many[part]).tobytes(),
                "doc": _planes(doc[part]),
                "nth": _planes(nth[part]),
                "place": _planes(place[part]),
            }
        )
    return rows


def shared_places(texts: DataFrame, keys_of: KeysOf, n_keys: float) -> DataFrame:
    """Rows (doc_id, nth, place, key) of all keys that several of the texts hold.

    ``texts`` has doc_id, nth and text, and (doc_id, nth) tells them apart; ``n_keys`` is the
    expected number of keys, which sets the number of buckets.
    """
    bits = max(4, int(np.ceil(np.log2(max(n_keys, 1) / BUCKET_KEYS + 1e-9))))
    shift = np.uint64(64 - bits)
    small = (np.int64, np.bool_, np.int32, np.int64, np.int32, np.int32)

    def sort(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        key, doc, nth, place, owner = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(key, kind="stable")
        key, doc, nth, place, owner = (c[order] for c in (key, doc, nth, place, owner))
        first = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(first) - 1
        begin = np.flatnonzero(first)
        differs = np.maximum.reduceat(owner, begin) != np.minimum.reduceat(owner, begin)
        many = differs[group]
        bucket = (key >> shift).astype(np.int64)
        low = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        sent = ~many | first
        rows = _packed(bucket[sent], low[sent], many[sent], doc[sent], nth[sent], place[sent], False)
        if many.any():
            rows += _packed(bucket[many], low[many], many[many], doc[many], nth[many], place[many], True)
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[at : at + 256], schema=_SENT)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, seen = [], 0, 0
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            nths = batch.column(1).to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, 64):
                part = batch.column(2).slice(at, 64).to_pylist()
                text, key, place = keys_of(part)
                if len(key):
                    held.append((key, docs[at + text], nths[at + text], place, seen + text))
                    count += len(key)
                seen += len(part)
                if count >= TASK_KEYS:
                    yield from sort(held)
                    held, count = [], 0
        if held:
            yield from sort(held)

    def meet(entries: pa.Table) -> pa.Table:
        told = []
        cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
        for turn in range(len(entries)):
            row = entries.slice(turn, 1).to_pylist()[0]
            n = row["n"]
            key = np.frombuffer(row["keys"], dtype="<u4")
            rest = [_unplanes(row[c], n) for c in ("doc", "nth", "place")]
            whole = key.astype(np.int64) | (row["bucket"] << 32)
            if row["known"]:
                told.append((*rest, whole))  # sent by the task that knew
            else:
                many = np.unpackbits(np.frombuffer(row["many"], dtype=np.uint8), count=n)
                for c, v, kind in zip(cols, (whole, many, np.full(n, turn), *rest), small, strict=True):
                    c.append(v.astype(kind))
        if cols[0]:
            key, many, turn, doc, nth, place = (np.concatenate(c) for c in cols)
            order = np.argsort(key, kind="stable")
            key, many, turn = key[order], many[order], turn[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            begin = np.flatnonzero(first)
            shared = np.logical_or.reduceat(many, begin)
            shared |= np.maximum.reduceat(turn, begin) != np.minimum.reduceat(turn, begin)
            # entries that stand for many have told their places
            reply = shared[np.cumsum(first) - 1] & ~many
            at = order[reply]
            told.append((doc[at], nth[at], place[at], key[reply]))
        if not told:
            return _TOLD.empty_table()
        columns = (np.concatenate(c) for c in zip(*told, strict=True))
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _TOLD, strict=True)], schema=_TOLD
        )

    schema = "bucket long, known boolean, n int, keys binary, many binary, doc binary, nth binary, place binary"
    sent = texts.select("doc_id", F.col("nth").cast("int").alias("nth"), "text").mapInArrow(scan, schema)
    return sent.groupBy("bucket").applyInArrow(meet, "doc_id long, nth int, place int, key long")


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Whether each value is least in some window of ``width`` values that lies in the array."""
    if len(h) <= width:
        return h == h.min() if len(h) else np.zeros(0, dtype=bool)
    least = _sliding(h, width, np.minimum)
    padded = np.concatenate([np.zeros(width - 1, h.dtype), least, np.zeros(width - 1, h.dtype)])
    return h == _sliding(padded, width, np.maximum)


def _sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """Minimum or maximum of each window."""
    span = 1
    while 2 * span <= width:
        x = least(x[:-span], x[span:])
        span *= 2
    return least(x[: len(x) - (width - span)], x[width - span :]) if width > span else x
