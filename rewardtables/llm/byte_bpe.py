"""Operator 11: byte-level BPE encoding and decoding by recursive DuckDB queries.

A rank file gives byte strings and their ranks, which are the ids. The pattern cuts a text into words,
and every word is encoded by itself. The work runs in Spark tasks, each with a DuckDB connection in
its own process (in memory, one thread, no server, no files):

- encoding: rows (word, position, id) join the table of merges (two ids, the id of both together).
  A round of the recursion contracts each word's leftmost pair of least rank until none is left. In words
  over ``LONG`` bytes later pairs of that rank are contracted in the same round, those of a run one after the
  other, as the sequence of single contractions would do next; a word in which one of them could bring a
  pair of lesser rank beside it contracts the leftmost alone. So a word of one letter said a million times
  takes some twenty rounds, not a million. After ``ROUNDS`` such rounds the query starts again from its last rows,
  so that rows of old rounds do not pile up.
- decoding: rows (sequence, position, id) join the vocabulary, an aggregation in order of position joins
  the bytes. Long sequences are decoded in pieces of ``PIECE`` ids.

A word that is in the rank file as a whole is its id. No word of the public pattern goes on over a space behind
another character, so texts are cut there first. Each worker keeps the ids of some ``CACHED`` chunks and words;
new ones go to the query together, once per batch of texts. Nulls: null text is the empty text, without ids;
a null doc_id is kept. Equal rows are encoded each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED = 500_000
CACHED_BYTES = 40
#: texts and characters that a worker handles at once
TEXTS = 2_000
CHARACTERS = 2_000_000
#: bytes of words and numbers of ids in one query
WORD_BYTES = 400_000
IDS = 500_000
PIECE = 1 << 16
LONG = 64
ROUNDS = 64

# a row knows the id after it, and places are counted anew behind each contraction: no sort until the end
_SHORT = """
WITH RECURSIVE t(w, n, id, next_id, done) AS (
  SELECT w, pos, id, next_id, false FROM tokens
  UNION ALL
  (
  WITH ranked AS (
    SELECT p.w, p.n, p.id, p.next_id, m.id AS rank
    FROM t p LEFT JOIN merges m ON m.a = p.id AND m.b = p.next_id WHERE NOT done
  ),
  least AS (SELECT w, min(rank * 128 + n) AS best FROM ranked WHERE rank IS NOT NULL GROUP BY w),
  hits AS (
    SELECT l.w, l.best % 128 AS hit, l.best // 128 AS rank, q.next_id AS after
    FROM least l JOIN ranked q ON q.w = l.w AND q.n = l.best % 128 + 1
  )
  SELECT
    r.w, CASE WHEN n > hit THEN n - 1 ELSE n END, CASE WHEN n = hit THEN h.rank ELSE id END,
    CASE WHEN n = hit THEN after WHEN n = hit - 1 THEN h.rank ELSE next_id END, hit IS NULL
  FROM ranked r LEFT JOIN hits h ON h.w = r.w
  WHERE hit IS NULL OR n <> hit + 1
  )
)
SELECT w, id FROM t WHERE done ORDER BY w, n
"""

_LONG = """
WITH RECURSIVE t(round, w, pos, id) AS (
  SELECT 0, w, pos, id FROM tokens
  UNION ALL
  (
  WITH pairs AS (
    SELECT round, w, pos, id, lag(id) OVER near AS last_id, lead(id) OVER near AS next_id, lead(pos) OVER near AS next_pos
    FROM t WINDOW near AS (PARTITION BY w ORDER BY pos)
  ),
  ranked AS (SELECT p.*, m.id AS rank FROM pairs p LEFT JOIN merges m ON m.a = p.id AND m.b = p.next_id),
  least AS (SELECT w, min(rank) AS rank FROM ranked GROUP BY w HAVING min(rank) IS NOT NULL),
  hits AS (
    SELECT h.*, row_number() OVER run AS nth, coalesce(lag(next_pos) OVER run <> pos, true) AS apart
    FROM (SELECT r.* FROM ranked r JOIN least l ON l.w = r.w AND l.rank = r.rank) h
    WINDOW run AS (PARTITION BY w ORDER BY pos)
  ),
  several AS (SELECT w FROM hits WHERE nth = 2),
  beside AS (
    SELECT h.w, h.rank, h.last_id, n.next_id FROM hits h SEMI JOIN several s ON s.w = h.w
    LEFT JOIN ranked n ON n.w = h.w AND n.pos = h.next_pos
  ),
  lowered AS (
    SELECT y.w FROM (
      SELECT w, rank AS a, next_id AS b FROM beside UNION ALL
      SELECT w, rank, rank FROM beside UNION ALL
      SELECT w, last_id, rank FROM beside
    ) y SEMI JOIN lowering x ON x.a = y.a AND x.b = y.b
  ),
  runs AS (SELECT *, sum(apart::INT) OVER (PARTITION BY w ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM hits),
  chosen AS (
    SELECT w, pos, next_pos, rank FROM runs
    QUALIFY row_number() OVER (PARTITION BY w, run ORDER BY pos) % 2 = 1
    AND (nth = 1 OR w NOT IN (SELECT w FROM lowered))
  )
  SELECT r.round + 1, r.w, r.pos, coalesce(c.rank, r.id)
  FROM ranked r SEMI JOIN least l ON l.w = r.w LEFT JOIN chosen c ON c.w = r.w AND c.pos = r.pos
  WHERE r.round < {rounds} AND NOT EXISTS (SELECT 1 FROM chosen g WHERE g.w = r.w AND g.next_pos = r.pos)
  )
)
SELECT t.w, t.pos, t.id, t.round
FROM t SEMI JOIN (SELECT w, max(round) AS round FROM t GROUP BY w) f ON f.w = t.w AND f.round = t.round
ORDER BY t.w, t.pos
"""

_DECODED = """
SELECT n, unhex(array_to_string(list(hex ORDER BY pos), '')) AS raw, count(*) - count(hex) AS unknown
FROM (SELECT n, unnest(ids) AS id, unnest(range(len(ids)))::INT AS pos FROM coded)
LEFT JOIN vocabulary USING (id)
GROUP BY n ORDER BY n
"""


def rank_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the public rank file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_pattern() -> str:
    """The public vocabulary's pattern of words."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings with their ids: a line has a base64 string and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class ByteBpe:
    """Encoder and decoder of one rank file and pattern."""

    _open: dict[tuple[str, str], ByteBpe] = {}

    def __init__(self, path: str, pattern: str) -> None:
        import duckdb
        import regex

        self._ranks = ranks = read_ranks(path)
        # white space is the property of that name, which leaves the separators 1C to 1F out
        self._cut = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self._bytes = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self._chunked = pattern == word_pattern()
        white = r"\s\p{White_Space}\x1c-\x1f"
        self._odd = regex.compile(f"[{white}] ").search
        self._cuts = regex.compile(f"(?<=[^{white}]) ").finditer
        self._chunks: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}
        self._db = duckdb.connect(config={"threads": 1, "temp_directory": "", "memory_limit": "2GB"})
        self._db.execute("SET enable_progress_bar = false")
        merges = [
            (ranks[t[:i]], ranks[t[i:]], rank)
            for t, rank in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        a, b, both = zip(*merges, strict=True) if merges else ((), (), ())
        pairs = pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "id": pa.array(both, pa.int32())})
        words = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
        self._db.register("given", pairs)
        self._db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self._db.execute("CREATE TABLE lowering AS SELECT a, b FROM merges WHERE id < greatest(a, b)")
        self._db.register("given", words)
        self._db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self._db.unregister("given")

    @classmethod
    def of(cls, path: str, pattern: str) -> ByteBpe:
        """The worker's own one."""
        if (path, pattern) not in cls._open:
            cls._open[path, pattern] = cls(path, pattern)
        return cls._open[path, pattern]

    def _table(self, name: str, rows: pa.Table, sql: str) -> pa.Table:
        self._db.register(name, rows)
        try:
            return self._db.sql(sql).to_arrow_table()
        finally:
            self._db.unregister(name)

    def _start(self, words: list[bytes]) -> pa.Table:
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        w = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = (np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        return pa.table({"w": w, "pos": pos, "id": self._bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]})

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words up to ``LONG`` bytes, each merged from its bytes."""
        rows = self._start(words)
        w, ids = rows["w"].to_numpy(), rows["id"].to_numpy()
        after = np.append(ids[1:], -1).astype(np.int32)
        after[np.flatnonzero(np.diff(w, append=-1))] = -1
        w, ids = (c.to_numpy() for c in self._table("tokens", rows.append_column("next_id", pa.array(after)), _SHORT).columns)
        return np.split(ids, np.searchsorted(w, np.arange(1, len(words)))) if words else []

    def merge_long(self, words: list[bytes], rounds: int = ROUNDS) -> list[np.ndarray]:
        """Ids of words of any length."""
        done: list[np.ndarray] = [np.empty(0, dtype=np.int32)] * len(words)
        rows = self._start(words)
        while len(rows):
            last = self._table("tokens", rows, _LONG.format(rounds=rounds))
            w, pos, ids, at = (c.to_numpy() for c in last.columns)
            open_ = at == rounds
            ended = np.flatnonzero(~open_)
            cuts = np.flatnonzero(np.diff(w[ended])) + 1
            for part in np.split(ended, cuts) if len(ended) else []:
                done[w[part[0]]] = ids[part]
            rows = pa.table({"w": w[open_], "pos": pos[open_], "id": ids[open_]})
        return done

    def _learn_words(self, words: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        open_: dict[bool, list[tuple[str, bytes]]] = {False: [], True: []}
        for word in words:
            raw = word.encode("utf-8", "replace")
            if (rank := self._ranks.get(raw)) is not None:
                found[word] = rank.to_bytes(4, "little")
            else:
                open_[len(raw) > LONG].append((word, raw))
        for long, items in open_.items():
            merge = self.merge_long if long else self.merge
            held, size = [], 0
            for i, item in enumerate(items):
                held.append(item)
                size += len(item[1])
                if size >= WORD_BYTES or i == len(items) - 1:
                    for (word, _), ids in zip(held, merge([r for _, r in held]), strict=True):
                        found[word] = ids.astype("<i4").tobytes()
                    held, size = [], 0
        return found

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of texts word by word."""
        cut = [self._cut(c) for c in chunks]
        fresh = self._learn_words(list(set().union(*cut).difference(self._words)))
        self._words.update(fresh)
        out = [b"".join(map(self._words.__getitem__, words)) for words in cut]
        _trim(self._words, fresh)
        return out

    def chunks(self, text: str) -> list[str]:
        """The text cut before spaces behind other characters, which are left out."""
        if not self._chunked:
            return [text]
        if not self._odd(" " + text):
            return text.split(" ")
        ends = [m.start() for m in self._cuts(text)]
        return [text[a:b] for a, b in zip([0, *(e + 1 for e in ends)], [*ends, len(text)], strict=True)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts."""
        cut = [self.chunks(t or "") for t in texts]
        begins = [c.pop(0) for c in cut]
        new = list(set().union(*cut).difference(self._chunks))
        ids = self._learn([*begins, *(" " + c for c in new)])
        fresh = dict(zip(new, ids[len(begins) :], strict=True))
        self._chunks.update(fresh)
        of = self._chunks.__getitem__
        out = [np.frombuffer(i + b"".join(map(of, chunks)), dtype="<i4") for i, chunks in zip(ids, cut)]
        _trim(self._chunks, fresh)
        return out

    def decode(self, coded: list[np.ndarray]) -> list[bytes]:
        """Bytes of id sequences; an id outside the vocabulary is an error."""
        pieces = [(i, ids[at : at + PIECE]) for i, ids in enumerate(coded) for at in range(0, len(ids), PIECE)]
        out: list[list[bytes]] = [[] for _ in coded]
        held, size = [], 0
        for k, (_, ids) in enumerate(pieces):
            held.append(k)
            size += len(ids)
            if size >= IDS or k == len(pieces) - 1:
                stops = np.cumsum([0, *(len(pieces[j][1]) for j in held)])
                values = pa.array(np.concatenate([pieces[j][1] for j in held]), pa.int32())
                lists = pa.LargeListArray.from_arrays(pa.array(stops, pa.int64()), values)
                rows = pa.table({"n": pa.array(held, pa.int64()), "ids": lists})
                n, raw, unknown = self._table("coded", rows, _DECODED).columns
                if unknown := pc.sum(unknown).as_py():
                    raise ValueError(f"{unknown} ids have no entry in the rank file")
                for j, part in zip(n.to_pylist(), raw.to_pylist(), strict=True):
                    out[pieces[j][0]].append(part)
                held, size = [], 0
        return [b"".join(parts) for parts in out]


def _trim(known: dict, fresh: dict) -> None:
    """Forget what came last, where there is no room, and long keys."""
    for key in fresh if len(known) > CACHED else [k for k in fresh if len(k) > CACHED_BYTES]:
        del known[key]


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``TEXTS`` rows and about ``CHARACTERS`` bytes or values."""
    for batch in batches:
        held = batch.column(column)
        size_of = pc.binary_length if pa.types.is_string(held.type) else pc.list_value_length
        sizes = pc.fill_null(size_of(held), 0).to_pylist()
        begin, size = 0, 0
        for i, n in enumerate(sizes):
            if i > begin and (size + n > CHARACTERS or i - begin >= TEXTS):
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    stops = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))


def encode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Ids of every text: columns doc_id, ids."""
    path, words = ranks or rank_path(), pattern or word_pattern()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(path, words)
        for batch in _parts(batches, "text"):
            ids = bpe.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(coded, f"doc_id {kind}, ids array<int>")


def decode(coded: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Bytes of every id sequence: columns doc_id, ids, decoded."""
    path, words = ranks or rank_path(), pattern or word_pattern()
    kind = coded.schema["doc_id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(path, words)
        for batch in _parts(batches, "ids"):
            lists = batch.column(1)
            stops, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            parts = [values[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]
            raw = pa.array(bpe.decode(parts), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], names=["doc_id", "ids", "decoded"])

    return coded.select("doc_id", "ids").mapInArrow(texts, f"doc_id {kind}, ids array<int>, decoded binary")


def recode(docs: DataFrame, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Ids of every text and the bytes that they give back: columns doc_id, ids, decoded; as ``decode(encode(docs))``
    but in one pass."""
    path, words = ranks or rank_path(), pattern or word_pattern()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(path, words)
        for batch in _parts(batches, "text"):
            ids = bpe.encode(batch.column(1).to_pylist())
            raw = pa.array(bpe.decode(ids), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids), raw], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(both, f"doc_id {kind}, ids array<int>, decoded binary")


def byte_bpe(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_tokens, digests of the ids and of the text decoded from them."""
    back = recode(docs)
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
