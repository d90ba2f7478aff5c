"""Operator 4: near-duplicates by bottom-k sketches of one hash function.

A document's set holds a 64-bit hash of every distinct five-word shingle; its sketch the ``K``
least values. Two sets of similarity 0.75 or more share at least ``NEEDED`` of their K least
values but with a chance under 1e-14 (and all values of sets smaller than K), so they share
one of the K - NEEDED + 1 values of their sketches that are rarest in the corpus. Only
those enter the inverted lists; a sketch with so many values of its own meets no list.

Equal sets are one class, known by a 128-bit digest. Components need no pair inside a
list whose documents are connected already: first every class is compared with one hub of
its lists, then classes outside the main component of a list with the member that is most
like its hub; these pairs are estimated on the least K values of the union of the sketches and
then decided by the full sets. What is still outside is compared with all members of its
lists by the full sets, in blocks that return forests instead of pairs, so that no link is lost.

Nulls and texts without words have empty sets and link with nothing. Rows with equal
doc_id stay apart by their texts; equal rows share a class. A null doc_id names no component but its
own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rewardtables.llm.common import components, few_rows, steps
from rewardtables.llm.embedding import forest
from rewardtables.sources.scratch import staged

WIDTH = 5
K = 32
NEEDED = 4
HUB_ROUNDS = 1
BLOCK = 256
VALUES = 8_192
TASKS = 512
#: values of all sets that a task gets on average, at most: 8 MB
TASK_VALUES = 1 << 20

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers over all places."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A hash of each run of ``width`` word hashes; of the whole sequence if it is shorter."""
    width = min(width, len(h))
    n = len(h) - width + 1 if width else 0
    out = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        out = mixed(out + h[i : i + n] * _ODD[i])
    return out


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes; words lie between ASCII white space, A-Z lower-cased."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    words = text.encode("utf-8", "replace").lower().split()
    return np.unique(shingle_hashes(word_hashes(words)))


def set_key(values: np.ndarray) -> bytes:
    """Digest of a whole set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        sizes, keys, sketches = [], [], []
        for text in batch.column(1).to_pylist():
            values = shingle_set(text)
            sizes.append(len(values))
            keys.append(set_key(values))
            sketches.append(values[:K].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(sketches, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "key", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        keys, sets = [], []
        for text in batch.column(1).to_pylist():
            values = shingle_set(text)
            keys.append(set_key(values))
            sets.append(values.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
            names=["key", "full"],
        )


def rare_lists(classes: DataFrame) -> DataFrame:
    """Inverted lists of the values that any partner must share: value, id, n."""
    values = classes.select("id", F.explode("sketch").alias("value"))
    seen = values.groupBy("value").agg(F.count("*").alias("seen")).where("seen > 1")
    sizes = classes.select("id", "n", F.size("sketch").alias("k"))
    shared = values.join(seen, "value").join(sizes, "id")
    by_id = Window.partitionBy("id")
    order = by_id.orderBy("seen", "value").rowsBetween(Window.unboundedPreceding, 0)
    needed = F.ceil(F.col("k") * NEEDED / K)
    # values of one document only come first; they meet nobody
    alone = F.col("k") - F.count("*").over(by_id)
    return (
        shared.withColumn("place", alone + F.count("*").over(order))
        .where(F.col("place") <= F.col("k") - needed + 1)
        .select("value", "id", "n")
    )


def links(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes whose full sets have a similarity of 0.75 or more, and that."""
    known = classes.select("id", "sketch")
    pairs = pairs.join(known.toDF("a", "sketch_a"), "a").join(known.toDF("b", "sketch_b"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, K)
    both = F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b"))
    pairs = pairs.where(F.size(both) * K >= F.size(union) * NEEDED).select("a", "b")
    pairs = pairs.join(sets.toDF("a", "full_a"), "a").join(sets.toDF("b", "full_b"), "b")
    common = F.size(F.array_intersect("full_a", "full_b"))
    all_of = F.size("full_a") + F.size("full_b") - common
    return pairs.where(100 * common >= 75 * all_of).select("a", "b", (common / all_of).alias("alike"))


_NEAR = "4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)"


def _located(lists: DataFrame, linked: DataFrame) -> DataFrame:
    """Members of the lists that hold several components, with the main one of the list."""
    part = components(linked.select("a", "b"))
    member = lists.join(part, "id", "left").withColumn("component", F.coalesce("component", "id"))
    shares = member.groupBy("value", "component").agg(F.count("*").alias("members"))
    main = shares.groupBy("value").agg(
        F.max(F.struct("members", "component"))["component"].alias("main"),
        F.count("*").alias("parts"),
    )
    main = main.where("parts > 1").select("value", "main")
    return staged(member.join(main, "value"), "list-members")


def linked_rows(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Whether each set of a and each of b have a similarity of 0.75 or more.

    Common values are counted by products of tables of sets by values, ``VALUES`` of them at a time.
    """
    values = np.intersect1d(np.concatenate(a), np.concatenate(b))

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(place among the values, set), by place."""
        whole, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.searchsorted(values, whole)
        held = at < len(values)
        held[held] = values[at[held]] == whole[held]
        at, owner = at[held], owner[held]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    def table(n: int, at: np.ndarray, owner: np.ndarray, begin: int) -> np.ndarray:
        lo, hi = np.searchsorted(at, [begin, begin + VALUES])
        out = np.zeros((n, min(VALUES, len(values) - begin)), dtype=np.float32)
        out[owner[lo:hi], at[lo:hi] - begin] = 1
        return out

    of_a, of_b = places(a), places(b)
    common = np.zeros((len(a), len(b)), dtype=np.int64)
    for begin in range(0, len(values), VALUES):
        product = table(len(a), *of_a, begin) @ table(len(b), *of_b, begin).T
        common += np.rint(product).astype(np.int64)
    sizes = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None]
    return 100 * common >= 75 * (sizes - common)


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _block_links(block: pa.Table) -> pa.Table:
    """A forest that connects what is linked between the two sides of every block."""
    keys = block.select(["main", "part_a", "part_b"]).to_pandas()
    side = block.column("outside").to_numpy(zero_copy_only=False)
    ids = block.column("id").to_numpy()
    out: list[tuple[int, int]] = []
    for at in keys.groupby(["main", "part_a", "part_b"], sort=False).indices.values():
        left, right = at[side[at]], at[~side[at]]
        if not len(left) or not len(right):
            continue
        chosen = block.column("full").take(pa.array(np.concatenate([left, right])))
        sets = [x.values.to_numpy(zero_copy_only=False) for x in chosen]
        linked = linked_rows(sets[: len(left)], sets[len(left) :])
        linked[ids[left][:, None] == ids[right][None]] = False
        of_left, of_right = forest(linked)
        names = ids[right]
        out += [(ids[left[i]], names[of_left[i]]) for i in np.flatnonzero(of_left >= 0)]
        out += [(names[i], names[of_right[i]]) for i in np.flatnonzero(of_right >= 0) if of_right[i] != i]
    columns = list(zip(*out, strict=True)) or [[], []]
    return pa.Table.from_arrays([pa.array([int(x) for x in c], pa.int64()) for c in columns], schema=_EDGES)


def rest_links(member: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (as forests) between members outside the main component and all members of their lists.

    Lists of one main component are compared together, so a pair that shares many lists is
    compared once. Both sides are cut into blocks; a task gets the sets of two blocks.
    """
    ids = member.select("main", "id", "n", (F.col("component") != F.col("main")).alias("outside"))
    ids = staged(ids.groupBy("main", "id").agg(F.max("outside").alias("outside"), F.first("n").alias("n")), "compared")
    sizes = ids.groupBy("main").agg(
        F.ceil(F.sum(F.col("outside").cast("int")) / BLOCK).alias("parts_a"),
        F.ceil(F.count("*") / BLOCK).alias("parts_b"),
    )
    # every task's share of a large group is a block; small groups travel as they are
    cut = ids.join(sizes, "main")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = cut.where("outside").select(
        "main", F.pmod(F.xxhash64("id"), "parts_a").alias("part_a"), every("parts_b").alias("part_b"),
        F.lit(True).alias("outside"), "id",
    )
    right = cut.select(
        "main", every("parts_a").alias("part_a"), F.pmod(F.xxhash64("id"), "parts_b").alias("part_b"),
        F.lit(False).alias("outside"), "id",
    )
    rows = left.unionByName(right).join(sets, "id")
    # tasks grow in number, not in size
    values = cut.select((F.col("n") * (F.col("parts_a") + F.when(F.col("outside"), F.col("parts_b")).otherwise(0))).alias("n"))
    tasks = max(TASKS, (values.agg(F.sum("n")).first()[0] or 0) // TASK_VALUES)
    task = F.pmod(F.xxhash64("main", "part_a", "part_b"), F.lit(tasks)).alias("task")
    return rows.select(task, "*").groupBy("task").applyInArrow(_block_links, "a long, b long")


def near_links(docs: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes with a number (id), and links that connect all that chains of near-duplicates do."""
    classes = staged(
        base.where("n_shingles > 0")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    lists = staged(rare_lists(classes), "rare-lists")
    # a list of one is left where a partner's prefix ended before the value
    listed = classes.join(lists.select("id").distinct(), "id")
    listed = staged(listed.select("id", "key", "doc_id", "sketch"), "listed")
    wanted = few_rows(listed.select("doc_id").distinct())
    texts = docs.select("doc_id", "text").where("doc_id is not null").join(wanted, "doc_id", "left_semi")
    nameless = docs.select("doc_id", "text").where("doc_id is null")
    numbers = few_rows(listed.select("key", "id"))
    sets = staged(
        texts.unionByName(nameless)
        .mapInArrow(_sets, "key binary, full array<long>")
        .join(numbers, "key")
        .select("id", "full"),
        "full-sets",
    )
    hubs = lists.groupBy("value").agg(F.min(F.struct("id", "n")).alias("hub"))
    stars = (
        lists.join(hubs, "value")
        .select(F.col("hub.id").alias("a"), F.col("hub.n").alias("n_a"), F.col("id").alias("b"), F.col("n").alias("n_b"))
        .where(f"a <> b and {_NEAR}")
        .groupBy("b", "a")
        .agg(F.count("*").alias("shared"))
        .groupBy("b")
        .agg(F.max(F.struct("shared", "a"))["a"].alias("a"))
    )
    found = staged(links(stars, listed, sets), "links")
    for _ in range(HUB_ROUNDS):
        member = _located(lists, found)
        if member.isEmpty():
            return classes, found.select("a", "b")
        # who is most like its hub is most like the others
        close = found.select(F.col("b").alias("id"), "alike").unionByName(
            found.select(F.col("a").alias("id"), "alike")
        )
        close = close.groupBy("id").agg(F.max("alike").alias("alike"))
        best = F.max(F.struct(F.coalesce("alike", F.lit(0.0)).alias("alike"), F.col("id").alias("a"), F.col("n").alias("n_a")))
        hub = member.where("component = main").join(close, "id", "left").groupBy("value").agg(best.alias("hub"))
        tries = (
            member.where("component <> main")
            .join(hub, "value")
            .select("hub.a", "hub.n_a", F.col("id").alias("b"), F.col("n").alias("n_b"))
            .where(_NEAR)
            .groupBy("b", "a")
            .agg(F.count("*").alias("shared"))
            .groupBy("b")
            .agg(F.max(F.struct("shared", "a"))["a"].alias("a"))
        )
        found = staged(found.unionByName(links(tries, listed, sets)), "links")
    rest = rest_links(_located(lists, found), sets)
    return classes, staged(found.select("a", "b").unionByName(rest), "links")


def minhash_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, key (digest of its set)."""
    base = staged(
        docs.select("doc_id", "text").mapInArrow(
            _sketches, "doc_id long, n_shingles long, key binary, sketch array<long>"
        ),
        "sketches",
    )
    classes, found = near_links(docs, base)
    sets = classes.select("key", "doc_id", "id").join(components(found), "id", "left")
    sets = sets.withColumn("component", F.coalesce("component", "id"))
    least = sets.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = sets.join(least, "component").select("key", "component_id")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        base.drop("sketch")
        .join(named, "key", "left")
        .select("doc_id", "n_shingles", alone.alias("component_id"), "key")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
