"""Operator 3: benchmark decontamination by a prefix-filtered set join, with built-in functions only.

An item's windows are its runs of 13 words (the whole item if it is shorter). A window is the
set of its shingles at their places: runs of three words (or of all words of a window that has
fewer). A document holds a window only if it holds all its shingles, so one of them suffices
as the prefix: the one that is rarest among all documents. Positions follow from it: a prefix
at word p lets the window begin at p minus the prefix's place only; windows that would begin
before or end behind the document are dropped. The others are verified: all shingles from there on,
at consecutive words, are the window's. Shingles are known by 64-bit hashes.

Only occurrences of benchmark shingles leave the scan. The distinct shingles of the
benchmark are sent to every executor if they are at most ``FEW_ROWS``; else they are shuffled.

Nulls: a null text has no words; items of null text or without words have no windows; a null
item_id is left out of ``n_items`` and the digest; a null doc_id is kept. Rows with equal
doc_id and text share their result, others stay apart. Empty tables give no rows, or no
hits. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rewardtables.llm.common import few_rows
from rewardtables.sources.scratch import staged

WINDOW = 13
SHINGLE = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_DOC = ("doc_id", "text_hash")


def words(text: Column) -> Column:
    """Words of digits, letters and all that is not ASCII, A-Z lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _GAPS), "")


def _runs(values: str, width: str, n: str) -> Column:
    """Runs of ``width`` elements of an array of n, n not under width."""
    return F.expr(f"transform(sequence(1, {n} - {width} + 1), i -> slice({values}, i, {width}))")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of all items: item_id, wid, n, width and the hashes of their shingles."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w"))
    items = items.withColumn("m", F.size("w")).where("m > 0")
    items = items.withColumn("n", F.least("m", F.lit(window)))
    items = items.select("item_id", "n", F.explode(_runs("w", "n", "m")).alias("w"))
    items = items.withColumn("width", F.least("n", F.lit(SHINGLE)))
    return items.select(
        "item_id",
        F.sha2(F.concat_ws(" ", "w"), 256).alias("wid"),
        "n",
        "width",
        F.transform(_runs("w", "width", "n"), lambda s: F.xxhash64(s)).alias("shingles"),
    )


def occurrences(docs: DataFrame, tokens: DataFrame, width: int) -> DataFrame:
    """Where documents hold benchmark shingles of one width."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    texts = texts.withColumn("n_words", F.size("w")).where(F.col("n_words") >= width)
    hashes = F.expr(
        f"transform(sequence(1, n_words - {width - 1}), i -> xxhash64(slice(w, i, {width})))"
    )
    at = texts.select(*_DOC, "n_words", F.posexplode(hashes).alias("pos", "shingle"))
    return at.join(tokens.where(F.col("width") == width), "shingle").distinct()


def contained_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Verified (doc_id, text_hash, wid, start, stop), and the items' windows."""
    items = staged(windows(benchmark, window), "windows")
    distinct = items.dropDuplicates(["wid"]).drop("item_id")
    tokens = few_rows(distinct.select("width", F.explode("shingles").alias("shingle")).distinct())
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # 1 to 3
    if not widths:
        widths = [SHINGLE]
    found = occurrences(docs, tokens, widths[0])
    for width in widths[1:]:
        found = found.unionByName(occurrences(docs, tokens, width))
    found = staged(found, "shingle-occurrences")

    seen = found.groupBy("width", "shingle").agg(F.count("*").alias("seen"))
    places = distinct.select("wid", "n", "width", F.posexplode("shingles").alias("place", "shingle"))
    prefix = (
        places.join(seen, ["width", "shingle"], "left")
        .groupBy("wid", "n", "width")
        .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "place", "shingle")).alias("p"))
        .where("p.seen > 0")
        .select("wid", "n", "width", "p.place", "p.shingle")
    )
    starts = (
        found.join(prefix, ["width", "shingle"])
        .withColumn("pos", F.col("pos") - F.col("place"))
        .where("pos >= 0 and pos + n <= n_words")
        .select(*_DOC, "width", "pos", "wid", "n")
    )
    ahead = Window.partitionBy(*_DOC, "width").orderBy("pos").rangeBetween(0, window - 1)
    runs = found.select(
        *_DOC,
        "width",
        "pos",
        F.collect_list("pos").over(ahead).alias("at"),
        F.collect_list("shingle").over(ahead).alias("run"),
    )
    same = (
        F.col("s.doc_id").eqNullSafe(F.col("r.doc_id"))
        & F.col("s.text_hash").eqNullSafe(F.col("r.text_hash"))
        & (F.col("s.width") == F.col("r.width"))
        & (F.col("s.pos") == F.col("r.pos"))
    )
    near = starts.alias("s").join(runs.alias("r"), same).select("s.*", "r.at", "r.run")
    checked = near.join(distinct.select("wid", "shingles"), "wid").where(
        "size(run) >= size(shingles) and slice(run, 1, size(shingles)) = shingles"
        " and at[size(shingles) - 1] = pos + size(shingles) - 1"
    )
    return checked.select(*_DOC, "wid", F.col("pos").alias("start"), (F.col("pos") + F.col("n")).alias("stop")), items


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash."""
    held, items = contained_windows(docs, benchmark, window)
    held = staged(held, "contained-windows")
    before = (
        Window.partitionBy(*_DOC)
        .orderBy("start", "stop")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    done = F.coalesce(F.max("stop").over(before), F.lit(0))
    covered = held.withColumn("new", F.greatest(F.col("stop") - F.greatest("start", done), F.lit(0)))
    hits = covered.groupBy(*_DOC).agg(F.sum("new").alias("n_hit"))
    names = (
        held.select(*_DOC, "wid")
        .distinct()
        .join(items.where("item_id is not null").select("wid", F.col("item_id").cast("string").alias("name")).distinct(), "wid")
        .groupBy(*_DOC)
        .agg(F.array_sort(F.collect_set("name")).alias("names"))
    )
    keyed = lambda df, x: F.struct(*(F.col(f"{x}.{c}") for c in _DOC))
    facts = hits.alias("h").join(names.alias("m"), keyed(hits, "h").eqNullSafe(keyed(names, "m")), "left")
    facts = facts.select("h.*", "m.names")
    sizes = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    every = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), sizes.cast("long").alias("n_words"))
    out = every.alias("d").join(facts.alias("f"), keyed(every, "d").eqNullSafe(keyed(facts, "f")), "left")
    hit = F.coalesce("f.n_hit", F.lit(0)).cast("long")
    found = F.coalesce("f.names", F.array().cast("array<string>"))
    return out.select(
        "d.doc_id",
        "d.n_words",
        hit.alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("d.n_words"))).alias("contaminated"),
        "d.text_hash",
    )
