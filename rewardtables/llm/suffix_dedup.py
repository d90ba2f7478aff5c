"""Operator 7: removal of repeated 50-byte strings by suffix arrays of linear grouping.

Any string of ``SPAN`` bytes holds an anchor: the 24 bytes of least hash in it. Anchors that several
documents hold are found by ``places.shared_places``; bytes that no shared anchor is near
repeat nowhere. Around a shared anchor a document's context reaches as far as a string of SPAN bytes
with the anchor in it can. Contexts are counted as distinct strings per anchor, each with its least
doc_id. What the contexts of one anchor can share is cut out: as far to the right and to the
left as the next in order agrees. These strings are joined to texts of about ``TEXT_BYTES``, whose
suffixes ``suffixes.suffix_array`` sorts by linear grouping. Neighbours that agree on SPAN
bytes are a repeat; its least doc_id is what all its places are judged by. An anchor with more than ``MANY`` distinct contexts (a short
line that stands in very many documents) is spread: its SPAN-byte strings are grouped by Spark, with
partial minima, and come to the same least doc_id.

Texts equal to that of a smaller doc_id are one class with it and removed whole, if they have SPAN bytes.

Nulls: a null text is empty; a document of null doc_id is kept whole and removes nothing. Rows with
equal doc_id stay apart by their texts and do not remove each other's bytes. An empty table
gives no rows. Other columns pass through ``without_repeats``; its text is what is left, with
the replacement character where a cut character remains.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.llm.common import FEW_ROWS, TEXTS_PER_STEP, few_rows, free_name, rows_of, steps
from rewardtables.llm.distinct import distinct_texts
from rewardtables.llm.minhash import mixed
from rewardtables.llm.places import shared_places, window_minima
from rewardtables.llm.suffixes import suffix_array
from rewardtables.sources.scratch import staged

SPAN = 50
ANCHOR = 24
TEXT_BYTES = 1 << 16
MANY = 20_000
GROUP_BYTES = 2 << 20


def _raw(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, hash, place) of every string that is least in some SPAN bytes."""
    raws = [_raw(t) for t in texts]
    sizes = np.array([len(r) for r in raws])
    raws = [r for r in raws if len(r) >= SPAN]
    kept = np.flatnonzero(sizes >= SPAN)
    if not raws:
        none = np.empty(0, dtype=np.int64)
        return none, none.astype(np.uint64), none
    whole = b"".join(raws)
    n = len(whole)
    words = np.empty(n - 7, dtype=np.uint64)
    for j in range(8):
        part = words[j::8]
        part[:] = np.frombuffer(whole, dtype="<u8", offset=j, count=len(part))
    m = n - ANCHOR + 1
    h = words[:m] * np.uint64(0x9E3779B97F4A7C15)
    h = mixed(h + words[8 : 8 + m] * np.uint64(0xC2B2AE3D27D4EB4F) + words[16 : 16 + m] * np.uint64(0x165667B19E3779F9))
    # windows over two texts add places at their borders, and take none away
    at = np.flatnonzero(window_minima(h, SPAN - ANCHOR + 1))
    stops = np.cumsum(sizes[kept])
    text = np.searchsorted(stops, at, side="right")
    inside = at + ANCHOR <= stops[text]
    at, text = at[inside], text[inside]
    return kept[text], h[at], at - (stops[text] - sizes[kept][text])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of the shared anchors of every document."""
    from xxhash import xxh3_64_intdigest

    for batch in steps(batches):
        anchor, cx, doc, nth, start, before, context = [], [], [], [], [], [], []
        for name, twin, text, places in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
            raw = _raw(text)
            for a in places:
                lo = max(0, a + ANCHOR - SPAN)
                part = raw[lo : a + SPAN]
                anchor.append(xxh3_64_intdigest(raw[a : a + ANCHOR]))
                cx.append(xxh3_64_intdigest(part, a - lo))
                start.append(lo)
                before.append(a - lo)
                context.append(part)
            doc += [name] * len(places)
            nth += [twin] * len(places)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(anchor, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(cx, dtype=np.uint64).view(np.int64)),
                pa.array(doc, pa.int64()),
                pa.array(nth, pa.int32()),
                pa.array(start, pa.int32()),
                pa.array(before, pa.int32()),
                pa.array(context, pa.binary()),
            ],
            names=["anchor", "cx", "doc_id", "nth", "start", "before", "context"],
        )


def least_by_suffixes(contexts: list[bytes], least: np.ndarray) -> list[np.ndarray]:
    """For every SPAN bytes of every context: the least number of a context that holds them."""
    starts = np.cumsum([0] + [len(c) + 1 for c in contexts])
    text = b"".join(c + b"\0" for c in contexts)
    symbols = np.frombuffer(text, dtype=np.uint8).astype(np.int64) + 1
    symbols[starts[1:] - 1] = 0  # no byte of a context; repeats cannot cross it
    order = np.array(suffix_array(symbols.tolist()))
    owner = np.repeat(np.arange(len(contexts)), np.diff(starts))
    whole = np.zeros(len(text), dtype=bool)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        whole[a : b - SPAN] = True
    order = order[whole[order]]
    values = least[owner[order]]
    places = order.tolist()
    same = [text[a : a + SPAN] == text[b : b + SPAN] for a, b in zip(places, places[1:], strict=False)]
    begin = np.flatnonzero([True, *(not s for s in same)]) if places else []
    if len(begin):
        runs = np.minimum.reduceat(values, begin)
        values = np.repeat(runs, np.diff([*begin, len(values)]))
    out = np.zeros(len(text), dtype=np.int64)
    out[order] = values
    return [out[a : b - SPAN] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


_RUNS = pa.schema(
    [("anchor", pa.int64()), ("cx", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("least", pa.int64())]
)


def agreement(group: np.ndarray, parts: list[bytes], width: int) -> np.ndarray:
    """How many first bytes each part shares with another of its group at most."""
    order = np.array(sorted(range(len(parts)), key=lambda i: (group[i], parts[i])), dtype=np.int64)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))[order]
    padded = b"".join([parts[i].ljust(width, b"\0") for i in order.tolist()])
    table = np.frombuffer(padded, dtype=np.uint8).reshape(-1, width)
    shared = np.logical_and.accumulate(table[1:] == table[:-1], axis=1).sum(1)
    shared = np.minimum(shared, np.minimum(sizes[1:], sizes[:-1]))
    shared[group[order[1:]] != group[order[:-1]]] = 0
    out = np.zeros(len(parts), dtype=np.int64)
    out[order] = np.maximum(np.append(shared, 0), np.insert(shared, 0, 0))
    return out


def _repeated(group: np.ndarray, lo: np.ndarray, before: np.ndarray, contexts: list[bytes]):
    """(row, first start, least doc_id of every start) where contexts of a group may share strings."""
    right = agreement(group, [c[k:] for c, k in zip(contexts, before.tolist(), strict=True)], SPAN)
    left = agreement(group, [c[:k][::-1] for c, k in zip(contexts, before.tolist(), strict=True)], SPAN - ANCHOR)
    rows = np.flatnonzero(left + right >= SPAN).tolist()
    number: dict[tuple[int, bytes], int] = {}
    strings: list[bytes] = []
    least: list[int] = []
    of: list[int] = []
    for i in rows:
        key = (int(group[i]), contexts[i][before[i] - left[i] : before[i] + right[i]])
        n = number.setdefault(key, len(strings))
        if n == len(strings):
            strings.append(key[1])
            least.append(int(lo[i]))
        least[n] = min(least[n], int(lo[i]))
        of.append(n)
    found: list[np.ndarray] = [np.full(len(c) - SPAN + 1, m) for c, m in zip(strings, least, strict=True)]
    groups = np.array([g for g, _ in number], dtype=np.int64)
    several = np.flatnonzero(np.bincount(groups)[groups] > 1).tolist() if len(groups) else []
    held, size = [], 0
    for k, n in enumerate(several):
        held.append(n)
        size += len(strings[n])
        if size >= TEXT_BYTES and (k + 1 == len(several) or groups[several[k + 1]] != groups[n]) or k + 1 == len(several):
            numbers = np.array([least[n] for n in held], dtype=np.int64)
            for m, values in zip(held, least_by_suffixes([strings[m] for m in held], numbers), strict=True):
                found[m] = values
            held, size = [], 0
    for i, n in zip(rows, of, strict=True):
        yield i, int(before[i] - left[i]), found[n]


def _sorted_groups(block: pa.Table) -> pa.Table:
    """Runs of strings in every context that a smaller document holds, too."""
    block = block.sort_by([("anchor", "ascending"), ("cx", "ascending")])
    anchor, cx, lo, hi, before = (block.column(c).to_numpy() for c in ("anchor", "cx", "lo", "hi", "before"))
    contexts = block.column("context").to_pylist()
    first = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    group = np.cumsum(first) - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    starts = np.fromiter(map(len, contexts), dtype=np.int64, count=len(contexts)) - SPAN + 1
    rows: list[tuple[np.ndarray, ...]] = []
    plain = lo < hi  # all strings of a context repeat among the documents that hold it whole
    some = several.tolist()
    for k, at, values in _repeated(group[several], lo[several], before[several], [contexts[i] for i in some]):
        i = some[k]
        least = np.full(starts[i], lo[i])
        least[at : at + len(values)] = np.minimum(values, lo[i])
        begin = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
        low = least[begin]
        keep = low < hi[i]
        if keep.any():
            last = np.append(begin[1:], starts[i]) - 1
            rows.append((np.full(keep.sum(), i), begin[keep], last[keep], low[keep]))
        plain[i] = False
    alone = np.flatnonzero(plain)
    rows.append((alone, np.zeros(len(alone), np.int64), starts[alone] - 1, lo[alone]))
    i, begin, last, least = (np.concatenate(c) for c in zip(*rows, strict=True))
    columns = (anchor[i], cx[i], begin, last, least)
    return pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _RUNS, strict=True)], schema=_RUNS
    )


def _spread(contexts: DataFrame) -> DataFrame:
    """The same runs for anchors with very many contexts, one string at a time."""
    strings = contexts.select(
        "anchor",
        "cx",
        "lo",
        "hi",
        F.expr(f"explode(transform(sequence(0, length(context) - {SPAN}), i -> struct(i AS first, md5(substring(context, i + 1, {SPAN})) AS hash)))").alias("s"),
    ).select("anchor", "cx", "lo", "hi", "s.first", "s.hash")
    least = strings.groupBy("anchor", "hash").agg(F.min("lo").alias("least"))
    return (
        strings.join(least, ["anchor", "hash"])
        .where("least < hi")
        .select("anchor", "cx", "first", F.col("first").alias("last"), "least")
    )


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base, spans): distinct texts with n_bytes, and what to remove of each (doc_id, nth)."""
    base, texts = distinct_texts(docs, F.octet_length("text").alias("n_bytes"))
    n_bytes = base.agg(F.sum("n_bytes")).first()[0] or 0
    places = shared_places(texts, anchors, n_bytes * 2 / (SPAN - ANCHOR + 2))
    places = places.groupBy("doc_id", "nth").agg(F.collect_list("place").alias("places"))
    found = staged(
        texts.join(places, ["doc_id", "nth"]).mapInArrow(
            _contexts,
            "anchor long, cx long, doc_id long, nth int, start int, before int, context binary",
        ),
        "contexts",
    )
    contexts = staged(
        found.groupBy("anchor", "cx").agg(
            F.min("doc_id").alias("lo"),
            F.max("doc_id").alias("hi"),
            F.first("before").alias("before"),
            F.first("context").alias("context"),
        ),
        "distinct-contexts",
    )
    many = few_rows(contexts.groupBy("anchor").agg(F.count("*").alias("n")).where(f"n > {MANY}").select("anchor"))
    size = contexts.agg(F.sum(F.length("context"))).first()[0] or 0
    groups = max(64, size // GROUP_BYTES)
    few = contexts.join(many, "anchor", "left_anti").withColumn("group", F.pmod("anchor", F.lit(groups)))
    runs = few.groupBy("group").applyInArrow(
        _sorted_groups, "anchor long, cx long, first int, last int, least long"
    )
    runs = runs.unionByName(_spread(contexts.join(many, "anchor", "left_semi")))
    spans = (
        found.select("anchor", "cx", "doc_id", "nth", "start")
        .join(runs, ["anchor", "cx"])
        .where("doc_id > least")
        .groupBy("doc_id", "nth")
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("start") + F.col("first")).alias("a"),
                    (F.col("start") + F.col("last") + SPAN).alias("b"),
                )
            ).alias("spans")
        )
    )
    return base, spans


def merged(found: list[dict]) -> list[int]:
    """Maximal runs, as starts and stops in turn."""
    out: list[int] = []
    for a, b in sorted((s["a"], s["b"]) for s in found):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def cut(raw: bytes, spans: list[int]) -> bytes:
    """What is left without the spans."""
    stops = [0, *spans, len(raw)]
    return b"".join(raw[a:b] for a, b in zip(stops[::2], stops[1::2], strict=True))


def with_spans(docs: DataFrame, name: str = "spans") -> DataFrame:
    """All rows and columns, and the maximal runs of bytes to remove in a column of that name."""

    @F.arrow_udf("array<int>")
    def runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((merged(s) for s, in rows_of(batch)), pa.list_(pa.int32()), size=len(batch))

    base, spans = repeats(docs)
    spans = spans.select("doc_id", "nth", runs("spans").alias("_spans"))
    whole = F.when((F.col("doc_id") > F.col("least")) & (F.col("n_bytes") >= SPAN), F.array(F.lit(0), F.col("n_bytes")))
    marked = staged(
        base.join(spans, ["doc_id", "nth"], "left")
        .select("doc_id", "digest", F.coalesce(whole, "_spans").alias("_spans"))
        .where("_spans is not null")
        .toDF("_doc", "_digest", "_spans"),
        "spans",
    )
    # sent to every executor if few and short; else the texts are shuffled
    n, size = marked.agg(F.count("*"), F.coalesce(F.sum(F.size("_spans")), F.lit(0))).first()
    if n <= FEW_ROWS and size <= 4 * FEW_ROWS:
        marked = F.broadcast(marked)
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    return docs.alias("d").join(
        marked, (F.col("d.doc_id") == F.col("_doc")) & (digest == F.col("_digest")), "left"
    ).select(*columns, F.coalesce("_spans", F.array().cast("array<int>")).alias(name))


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = _raw(text or "")
                left = cut(raw, spans)
                out.append((len(raw), len(raw) - len(left), len(spans) // 2, hashlib.sha256(left).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return with_spans(docs.select("doc_id", "text")).mapInArrow(
        digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows and columns; the text is what is left of it."""

    @F.arrow_udf("string")
    def left(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, spans in batches:
            for at in range(0, len(text), TEXTS_PER_STEP):
                rows = rows_of(text.slice(at, TEXTS_PER_STEP), spans.slice(at, TEXTS_PER_STEP))
                cuts = [t if t is None or not s else cut(_raw(t), s).decode("utf-8", "replace") for t, s in rows]
                yield pa.array(cuts, pa.string())

    removed = free_name(docs, "_removed")
    marked = with_spans(docs, removed)
    return marked.withColumn("text", left("text", removed)).drop(removed)
