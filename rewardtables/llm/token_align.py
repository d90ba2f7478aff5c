"""Operator 13: alignment of two tokenizers' tokens, with corpus-wide counts of the pairs that overlap.

A text is encoded by a byte-level BPE (side A, of a space and the text) and a sentencepiece model (side B, which adds
the space). Byte offsets where tokens of both end cut them into groups; an A and a B occurrence whose bytes overlap
are a link. How many links hold an id pair is counted over the whole corpus by external spill counting:

- Tasks gather records (pair, document, links) and spill them as a run whenever ``RECORDS`` have come:
  partitioned by the low bits of the B id (``RADIX``), each part sorted by B id, A id and document, with the
  part's total of each pair, as zstd-compressed columns. Runs travel and lie as Spark rows: what an
  executor loses is made again.
- The totals of up to ``FAN`` runs of a part are merged by a heap in order of B and A ids, in as many rounds as it
  takes until one sequence a part is left. A sequence holds each pair once, so it is bounded by the
  vocabularies, however many documents hold a pair. B ids come as a whole, which gives their maxima.
- Each run's part is read again beside the totals of that part and gives the sums of its documents;
  the sums of the parts of a run are added up. Documents are never gathered by pair.

Neither side has tokens that go on over a space after other characters, so a text is cut there and each
distinct chunk is encoded, aligned and kept by the worker once; a piece file with such tokens is
encoded in whole texts. Nulls: texts that are null, empty, or whose bytes the tokens do not give back have
no tokens: zeros, and an empty string of groups. A null doc_id is kept. Equal rows count each. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.llm.common import steps
from rewardtables.sources.scratch import staged

RADIX = 64
FAN = 64
RECORDS = 1_000_000
#: documents of a run, and keys of a run that a merge handles at once
DOCUMENTS = 20_000
BLOCK = 1 << 14
CACHED = 400_000
CACHED_BYTES = 64
#: characters that are encoded in one call
CHARACTERS = 200_000

#: (tokens of A, tokens of B, groups, their text, pairs of the links); None if the bytes do not come back
Entry = tuple[int, int, int, bytes, bytes] | None


def tokenizer_paths() -> tuple[str, str]:
    """Where the public files of the two sides lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: itself if it is printable."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Aligner:
    """Encodes and aligns texts by two tokenizer files."""

    _open: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        stands = _byte_characters()
        vocabulary = self._a.get_vocab(with_added_tokens=True)
        self._bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            plain = all(c in stands for c in token)
            self._bytes_a[i] = bytes(stands[c] for c in token) if plain else token.encode()
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._bytes_b = [_piece_bytes(p) for p in pieces]
        self._length_a = np.array([len(x) for x in self._bytes_a], dtype=np.int64)
        self._length_b = np.array([len(x) for x in self._bytes_b], dtype=np.int64)
        self._space = self._b.piece_to_id("▁")
        self._whole = any("▁" in p.lstrip("▁") for p in pieces)
        white = r"\s\p{White_Space}\x1c-\x1f"  # more than either side takes for white space
        self._odd = regex.compile(f"[{white}] ").search
        self._cuts = regex.compile(f"(?<=[^{white}]) ").finditer
        self._blank = regex.compile(f"[{white}]").match
        self._known: dict[str, Entry] = {}

    @classmethod
    def of(cls, paths: tuple[str, str]) -> Aligner:
        """The worker's own one."""
        if paths not in cls._open:
            cls._open[paths] = cls(*paths)
        return cls._open[paths]

    def chunks(self, text: str) -> list[str]:
        """The text, a space before it, cut before spaces behind other characters; without their first space."""
        if self._whole:
            return [text]
        spaced = " " + text
        if not self._odd(spaced):
            return text.split(" ")
        ends = [m.start() for m in self._cuts(spaced)]
        return [spaced[a + 1 : b] for a, b in zip([0, *ends], [*ends, len(spaced)], strict=True)]

    def _aligned(self, chunks: list[str]) -> list[Entry]:
        """Entries of chunks that are encoded together; all but the last end in no white space."""
        spaced = " " + " ".join(chunks)
        raw = spaced.encode("utf-8", "replace")
        a = self._a.encode(spaced, add_special_tokens=False).ids
        b = self._b.encode(spaced[1:]) if len(spaced) > 1 else [self._space]
        if b"".join([self._bytes_a[i] for i in a]) != raw or b"".join([self._bytes_b[i] for i in b]) != raw:
            return [None] if len(chunks) == 1 else [self._aligned([c])[0] for c in chunks]
        ids_a, ids_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        end_a, end_b = np.cumsum(self._length_a[ids_a]), np.cumsum(self._length_b[ids_b])
        ends = np.union1d(end_a, end_b)
        # no two tokens of a side share bytes: each stretch between ends is one link
        pairs = ids_b[np.searchsorted(end_b, ends)] << 32 | ids_a[np.searchsorted(end_a, ends)]
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        upto_a = (np.searchsorted(end_a, both) + 1).tolist()
        upto_b = (np.searchsorted(end_b, both) + 1).tolist()
        said_a, said_b = list(map(str, a)), list(map(str, b))
        groups, x, y = [], 0, 0
        for i, j in zip(upto_a, upto_b, strict=True):
            groups.append(f"{said_a[x]}|{said_b[y]}" if i == x + 1 and j == y + 1 else ",".join(said_a[x:i]) + "|" + ",".join(said_b[y:j]))
            x, y = i, j
        if len(chunks) == 1:
            return [(len(a), len(b), len(groups), ";".join(groups).encode(), pairs.tobytes())]
        stops = np.cumsum([len(c.encode("utf-8", "replace")) + 1 for c in chunks])
        group = np.searchsorted(both, stops) + 1
        if not np.array_equal(both[group - 1], stops):
            raise ValueError("a token goes on over the end of a chunk")
        link = (np.searchsorted(ends, stops) + 1).tolist()
        out, held = [], pairs.tobytes()
        g0 = l0 = a0 = b0 = 0
        for g, k in zip(group.tolist(), link, strict=True):
            i, j = upto_a[g - 1], upto_b[g - 1]
            out.append((i - a0, j - b0, g - g0, ";".join(groups[g0:g]).encode(), held[8 * l0 : 8 * k]))
            g0, l0, a0, b0 = g, k, i, j
        return out

    def _learn(self, chunks: list[str]) -> dict[str, Entry]:
        found: dict[str, Entry] = {}
        held: list[str] = []
        size = 0
        for chunk in chunks:
            if self._whole or not chunk or self._blank(chunk[-1]):
                found[chunk] = self._aligned([chunk])[0]
                continue
            held.append(chunk)
            size += len(chunk) + 1
            if size >= CHARACTERS:
                found.update(zip(held, self._aligned(held), strict=True))
                held, size = [], 0
        if held:
            found.update(zip(held, self._aligned(held), strict=True))
        return found

    def align(self, texts: list[str | None]) -> list[list[Entry]]:
        """Entries of the chunks of every text; none for texts without tokens."""
        cut = [self.chunks(t) if t else [] for t in texts]
        known = self._known
        fresh = self._learn([c for c in set().union(*cut) if c not in known])
        out = [[known[c] if c in known else fresh[c] for c in chunks] for chunks in cut]
        if len(known) < CACHED:
            known.update((c, e) for c, e in fresh.items() if len(c) <= CACHED_BYTES)
        return [[] if None in entries else entries for entries in out]


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as zstd-compressed differences, byte by byte."""
    import zstandard

    steps_ = np.diff(values.astype(np.int64), prepend=0).astype("<i8")
    return zstandard.compress(steps_.view(np.uint8).reshape(-1, 8).T.tobytes(), 3)


def unpack(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(raw), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


_LISTS = ["n_a", "n_b", "n_groups", "n_links"]
_RUNS = (
    "run long, part int, keys binary, totals binary, sizes binary, docs binary, links binary,"
    " doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,"
    " groups array<string>"
)


_KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def _rows(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(",")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(name, _KINDS[kind]) for name, kind in fields]))


def spilled(run: int, held: list[tuple[np.ndarray, np.ndarray]]) -> list[dict]:
    """Rows of a run, one per part, of the pairs and numbers of links of its documents in order."""
    key = np.concatenate([k for k, _ in held])
    links = np.concatenate([n for _, n in held])
    doc = np.repeat(np.arange(len(held)), [len(k) for k, _ in held])
    part = (key >> 32) % RADIX
    order = np.lexsort((doc, key, part))
    key, links, doc, part = key[order], links[order], doc[order], part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    rows = []
    for at in np.split(np.arange(len(key)), cuts) if len(key) else []:
        first = np.flatnonzero(np.diff(key[at], prepend=-1))
        rows.append(
            {
                "run": run,
                "part": int(part[at[0]]),
                "keys": pack(key[at][first]),
                "totals": pack(np.add.reduceat(links[at], first)),
                "sizes": pack(np.diff(np.append(first, len(at)))),
                "docs": pack(doc[at]),
                "links": pack(links[at]),
            }
        )
    return rows


def runs_of(docs: DataFrame, paths: tuple[str, str], records: int = RECORDS) -> DataFrame:
    """Runs of pair records, a row per run and part, and a row (part -1) per run for its documents."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(paths)
        task, turn = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        told: dict[str, list] = {c: [] for c in ("doc_id", *_LISTS, "groups")}
        count = 0

        def run() -> Iterator[pa.RecordBatch]:
            number = task << 32 | turn
            rows = [{"run": number, "part": -1, **told}, *spilled(number, held)]
            for at in range(0, len(rows), 16):
                yield _rows(rows[at : at + 16], _RUNS)

        for batch in steps(batches):
            for name, entries in zip(batch.column(0).to_pylist(), aligner.align(batch.column(1).to_pylist()), strict=True):
                n_a, n_b, n_groups, groups, pairs = zip(*entries, strict=True) if entries else ((),) * 5
                keys = np.frombuffer(b"".join(pairs), dtype=np.int64)
                said = hashlib.sha256(b";".join(groups)).hexdigest() if entries else ""
                row = (name, sum(n_a), sum(n_b), sum(n_groups), len(keys), said)
                for c, v in zip(told, row, strict=True):
                    told[c].append(v)
                held.append(np.unique(keys, return_counts=True))
                count += len(held[-1][0])
                if count >= records or len(held) >= DOCUMENTS:
                    yield from run()
                    held, told, count, turn = [], {c: [] for c in told}, 0, turn + 1
        if held:
            yield from run()

    return docs.select("doc_id", "text").mapInArrow(scan, _RUNS)


def heap_merged(runs: list[tuple[np.ndarray, np.ndarray]], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (keys, totals) as one sequence in which every key comes once, by a heap over the runs' blocks.

    The heap has the last key of each run's block. All keys up to the least of these are at hand: they are
    added up, and the run whose block has ended goes on to its next.
    """
    at = [0] * len(runs)
    heap = [(int(k[min(block, len(k)) - 1]), i, min(block, len(k))) for i, (k, _) in enumerate(runs) if len(k)]
    heapq.heapify(heap)
    while heap:
        last = heap[0][0]
        keys, totals = [], []
        for _, i, stop in heap:
            k, t = runs[i]
            upto = at[i] + int(np.searchsorted(k[at[i] : stop], last, side="right"))
            keys.append(k[at[i] : upto])
            totals.append(t[at[i] : upto])
            at[i] = upto
        while heap and heap[0][0] == last:
            _, i, stop = heapq.heappop(heap)
            k = runs[i][0]
            if stop < len(k):
                upto = min(stop + block, len(k))
                heapq.heappush(heap, (int(k[upto - 1]), i, upto))
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), dtype=np.int64)
        np.add.at(total, where, np.concatenate(totals))
        yield key, total


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    runs = [(unpack(k), unpack(t)) for k, t in zip(table["keys"].to_pylist(), table["totals"].to_pylist(), strict=True)]
    keys, totals = zip(*heap_merged(runs), strict=True)
    return np.concatenate(keys), np.concatenate(totals)


def pair_totals(runs: DataFrame, fan: int = FAN) -> DataFrame:
    """Corpus-wide totals of all pairs, a row per part: part, all_keys, all_totals, best.

    ``best`` marks the pairs of the highest total of their B id.
    """
    sequences = runs.where("part >= 0").select("part", "run", "keys", "totals")
    left = runs.where("part < 0").count()

    def fold(key: tuple, table: pa.Table) -> pa.Table:
        keys, totals = _merged(table)
        row = {"part": key[0].as_py(), "run": key[1].as_py(), "keys": pack(keys), "totals": pack(totals)}
        return pa.Table.from_batches([_rows([row], "part int, run long, keys binary, totals binary")])

    while left > fan:
        left = -(-left // fan)
        some = F.pmod(F.xxhash64("run"), F.lit(left)).alias("run")
        sequences = staged(
            sequences.select("part", some, "keys", "totals")
            .groupBy("part", "run")
            .applyInArrow(fold, "part int, run long, keys binary, totals binary"),
            "sequences",
        )

    def close(table: pa.Table) -> pa.Table:
        keys, totals = _merged(table)
        first = np.flatnonzero(np.diff(keys >> 32, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(totals, first), np.diff(np.append(first, len(keys))))
        row = {
            "part": table["part"][0].as_py(),
            "all_keys": pack(keys),
            "all_totals": pack(totals),
            "best": np.packbits(totals == highest).tobytes(),
        }
        return pa.Table.from_batches([_rows([row], _TOTALS)])

    return sequences.groupBy("part").applyInArrow(close, _TOTALS)


_TOTALS = "part int, all_keys binary, all_totals binary, best binary"
_SUMS = "run long, part int, n_best binary, count_sum binary"
_ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the links of a run's part add to each of the run's documents."""
    for batch in steps(batches, 8):
        out = []
        for row in batch.to_pylist():
            place = np.searchsorted(unpack(row["all_keys"]), unpack(row["keys"]))
            sizes, docs, links = (unpack(row[c]) for c in ("sizes", "docs", "links"))
            best = np.unpackbits(np.frombuffer(row["best"], dtype=np.uint8)).astype(np.int64)
            sums = {}
            for name, value in (("n_best", best), ("count_sum", unpack(row["all_totals"]))):
                of_doc = np.zeros(int(docs.max()) + 1, dtype=np.int64)
                np.add.at(of_doc, docs, np.repeat(value[place], sizes) * links)
                sums[name] = pack(of_doc)
            out.append({"run": row["run"], "part": row["part"], **sums})
        yield _rows(out, _SUMS)


def _summed(table: pa.Table) -> pa.Table:
    """Rows of a run's documents with the sums of all its parts."""
    rows = table.to_pylist()
    (told,) = [r for r in rows if r["part"] < 0]
    sums = {c: np.zeros(len(told["doc_id"]), dtype=np.int64) for c in ("n_best", "count_sum")}
    for row in rows:
        if row["part"] >= 0:
            for name, total in sums.items():
                value = unpack(row[name])
                total[: len(value)] += value
    columns = {c: told[c] for c in ("doc_id", *_LISTS)} | sums | {"groups_sha256": told["groups"]}
    kinds = {"groups_sha256": pa.string()}
    return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in columns.items()})


def token_alignment(
    docs: DataFrame, paths: tuple[str, str] | None = None, records: int = RECORDS, fan: int = FAN
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    runs = staged(runs_of(docs, paths or tokenizer_paths(), records), "runs")
    totals = staged(pair_totals(runs, fan), "totals")
    lists = ("doc_id", *_LISTS, "groups")
    sums = (
        runs.where("part >= 0")
        .select("run", "part", "keys", "sizes", "docs", "links")
        .join(totals, "part")
        .mapInArrow(_contributions, _SUMS)
    )
    told = runs.where("part < 0").select("run", "part", *lists)
    return told.unionByName(sums, allowMissingColumns=True).groupBy("run").applyInArrow(_summed, _ALIGNED)
