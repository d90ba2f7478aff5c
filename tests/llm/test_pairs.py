"""Operators 1 and 4 against all pairs."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rewardtables.llm import embedding, minhash
from rewardtables.llm.common import components

from .helpers import documents


def reachable(ids, links):
    low = {i: i for i in ids}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components_of_paths_stars_and_cycles(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 700)]
    links += [(900, 901), (901, 902), (902, 900), (5, 5)]
    links += [tuple(x) for x in rng.integers(1000, 1400, (350, 2)).tolist()]
    order = rng.permutation(len(links))
    df = spark.createDataFrame([links[i] for i in order], "a long, b long")
    ids = {i for a, b in links if a != b for i in (a, b)}
    assert dict(map(tuple, components(df).collect())) == reachable(ids, links)
    assert components(df.where("a < 0")).collect() == []


def clusters(n=400, dim=16, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.15, 0.3], n)[:, None]
    x[50:60] = x[50]
    return x


def check_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, key string")
    got = {r.vec_id: r for r in embedding.embedding_dedup(df).collect()}
    assert len(got) == len(rows)
    unit = {r[0]: embedding.unit(r[1]) for r in rows}
    ids = [i for i, u in unit.items() if u is not None]
    links = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9
    ]
    counts = dict.fromkeys(unit, 0)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    found = sum(r.n_links for r in got.values())
    assert found >= 0.99 * 2 * len(links)
    assert all(got[i].n_links <= counts[i] for i in unit)
    return got, counts, reachable(unit, links)


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 37)  # cells of many blocks
    monkeypatch.setattr(embedding, "CELL", 20)
    rows = [(i, v.tolist(), i % 3, "x") for i, v in enumerate(clusters())]
    rows += [
        (900, None, 0, "x"),
        (901, [], 0, "x"),
        (902, [0.0] * 16, 0, "x"),
        (903, [1.0] * 15 + [None], 0, "x"),
        (904, [1.0] * 15 + [float("nan")], None, "x"),
        (905, [float("inf")] + [1.0] * 15, 0, "x"),
        (906, [1.0, 1.0], 0, "x"),
        (907, [2.0, 2.0], 0, "x"),
        (908, [1e308] * 16, 0, "x"),
        (909, [1e-308] * 16, 0, "x"),
    ]
    got, counts, low = check_vectors(spark, rows)
    for r in got.values():
        assert r.kept == (r.component_id == r.vec_id)
        if r.n_links == counts[r.vec_id]:
            continue
    assert [got[i].n_links for i in range(900, 906)] == [0] * 6
    assert got[907].component_id == 906 and got[909].component_id == 908
    same = sum(got[i].component_id == low[i] for i in low)
    assert same >= 0.99 * len(low)


def test_a_round_of_embeddings_moves_each_vector_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(embedding, "ROUND_BYTES", 1, raising=False)  # a turn is a round
    monkeypatch.setattr(embedding, "CELL", 5)
    compare, write = embedding._compare, embedding.staged

    def counting(*args):
        inner = compare(*args)

        def counted(block):
            n = sum(block.column("n").to_pylist()) if "n" in block.column_names else len(block)
            (tmp_path / uuid.uuid4().hex).write_text(str(n))
            return inner(block)

        return counted

    moved = []

    def staged(df, name):
        before = set(tmp_path.iterdir())
        out = write(df, name)
        if name == "vector-links":
            moved.append(sum(int(f.read_text()) for f in set(tmp_path.iterdir()) - before))
        return out

    monkeypatch.setattr(embedding, "_compare", counting)
    monkeypatch.setattr(embedding, "staged", staged)
    vectors = clusters(1500, 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    assert embedding.embedding_dedup(df).count() == len(vectors)
    assert 0 < max(moved) <= len(vectors)


def test_embeddings_of_large_cells_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 30)
    monkeypatch.setattr(embedding, "EVEN", 0.1)
    monkeypatch.setattr(embedding, "CELL", 10)
    monkeypatch.setattr(embedding, "PACK", 50)
    rows = [(i, v.tolist(), 0, "x") for i, v in enumerate(clusters())]
    got, counts, low = check_vectors(spark, rows)
    assert sum(got[i].n_links == counts[i] for i in counts) >= 0.98 * len(counts)
    assert sum(got[i].component_id == low[i] for i in low) >= 0.99 * len(low)


def test_cells_of_embeddings_of_any_size(monkeypatch):
    rng = np.random.default_rng(6)
    x = embedding.units(np.concatenate([clusters(700, 24), rng.normal(size=(300, 24))]))
    monkeypatch.setattr(embedding, "CELL", 40)
    books = embedding.Codebooks(x, len(x), 0.9)
    keys = rng.integers(0, 256, (len(x), 16)).astype("u1")
    codes = books.codes(x).astype("<i2")
    pack = embedding.Pack(x.shape[1] * 8, keys, np.ones((len(x), 1), np.int64), x.view("u1").reshape(len(x), -1), codes)
    batch = pa.RecordBatch.from_pylist([pack.row()], schema=embedding.arrow(embedding._PACK))
    want = (x @ x.T >= 0.9).sum(1) - 1
    every = {(pack.size, t, c): 3 for t in range(codes.shape[1]) for c in range(codes.max() + 1)}
    for small, tile, parts in ((96, 256, {}), (8, 16, {}), (8, 16, every)):
        monkeypatch.setattr(embedding, "SMALL", small)
        monkeypatch.setattr(embedding, "TILE", tile)
        groups = {}
        for out in embedding._deal(range(100), parts)([batch]):
            for r in out.to_pylist():
                groups.setdefault(tuple(r[c] for c in ("turn", "cell", "one", "other")), []).append(r)
        counts = dict.fromkeys(map(bytes, keys), 0)
        for rows in groups.values():
            block = pa.Table.from_pylist(rows, schema=embedding.arrow(embedding._DEALT))
            for r in embedding._compare(0.9)(block).to_pylist():
                counts[r["key"]] += r["links"]
        assert 0.99 * want.sum() <= sum(counts.values())
        assert all(counts[bytes(k)] <= n for k, n in zip(keys, want, strict=True))


def test_cosines_at_the_threshold_are_worked_out_in_double_precision(spark):
    rng = np.random.default_rng(5)
    x = embedding.units(rng.normal(size=(200, 32)))
    y = rng.normal(size=x.shape)
    y = embedding.units(y - (x * y).sum(1)[:, None] * x)
    cosine = 0.9 + np.tile([1e-9, -1e-9], 100)[:, None]
    near = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * y])
    rows = [(i, v.tolist(), 0, "x") for i, v in enumerate(near)]
    got, counts, _ = check_vectors(spark, rows)
    assert sum(counts.values()) == 200
    assert {i: r.n_links for i, r in got.items()} == counts


def test_embeddings_without_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding.embedding_dedup(df).collect() == []


def test_forest():
    linked = np.zeros((4, 5), dtype=bool)
    linked[0, 3] = linked[1, 3] = linked[1, 1] = linked[3, 4] = True
    rows, cols = embedding.forest(linked)
    assert rows.tolist() == [1, 1, -1, 4]
    assert cols.tolist() == [-1, 1, -1, 1, 4]


def plain_sets(rows):
    out = []
    for name, text in rows:
        words = (text or "").encode().lower().split()
        out.append((name, frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()))
    return out


def near_copies(seed=4):
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"w{i}" for i in range(900)])
    rows, name = [], 0
    for size in (4, 5, 8, 30, 31, 60, 200, 400):
        base = rng.choice(vocabulary, size)
        for change in (0, 0, 1, 1, 2, 3, 4, 8):
            words = base.copy()
            words[rng.integers(0, size, change)] = rng.choice(vocabulary, change)
            rows.append((name, " ".join(words)))
            name += 1
    line = " ".join(rng.choice(vocabulary, 40))
    for _ in range(30):  # one line in many documents
        rows.append((name, line + " " + " ".join(rng.choice(vocabulary, 60))))
        name += 1
    base = rng.choice(vocabulary, 120)  # a large group of near copies, some of them barely so
    for _ in range(60):
        words = base.copy()
        change = rng.integers(1, 7)
        words[rng.integers(0, 120, change)] = rng.choice(vocabulary, change)
        rows.append((name, " ".join(words)))
        name += 1
    rows += [(name, None), (name + 1, ""), (name + 2, " \n"), (name + 3, "É é"), (name + 4, "é é")]
    order = rng.permutation(len(rows))
    return [rows[i] for i in order]


def test_near_duplicates_are_those_of_all_pairs(spark):
    rows = near_copies()
    sets = plain_sets(rows)
    links = [
        (a, b)
        for a, x in sets
        for b, y in sets
        if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    low = reachable([a for a, _ in rows], links)
    got = minhash.minhash_dedup(documents(spark, rows)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (a, len(x), low[a], low[a] == a) for a, x in sets
    }
    assert len(got) == len(rows)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "x " * 30000), (2, "other words here")]
    got = minhash.minhash_dedup(documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got) == [
        (-1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 1, 2), (2, 1, 2),
    ]
    assert minhash.minhash_dedup(documents(spark, [])).collect() == []


def test_final_pairs_alone_find_all_links(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HUB_ROUNDS", 0)
    rows = near_copies(7)
    got = {r.doc_id: r.component_id for r in minhash.minhash_dedup(documents(spark, rows)).collect()}
    monkeypatch.undo()
    again = minhash.minhash_dedup(documents(spark, rows)).select("doc_id", F.col("component_id").alias("c"))
    assert got == {r.doc_id: r.c for r in again.collect()}


def test_chance_to_miss_a_near_duplicate():
    from math import comb

    from rewardtables.llm.minhash import K, NEEDED

    missed = sum(comb(K, i) * 0.75**i * 0.25 ** (K - i) for i in range(NEEDED))
    assert missed * 1e12 < 0.1  # links lost of 10 ** 12 at the very threshold


def test_blocks_to_compare_go_to_tasks_of_bounded_size(spark, monkeypatch):
    """Sets of 40 values in one group: a task gets some of its blocks, however many there are."""
    n, per = 400, 40
    member = spark.createDataFrame([(7, i, per, i % 4, 0) for i in range(n)], "value LONG, id LONG, n LONG, component LONG, main LONG")
    sets = [(i, [(i // 8 * 8 if i % 4 == 1 else i) * 1_000 + k for k in range(per)]) for i in range(n)]
    sets = spark.createDataFrame(sets, "id LONG, full ARRAY<LONG>")

    whole = minhash._block_links

    def bounded(block):
        assert block.num_rows < 400, block.num_rows
        return whole(block)

    monkeypatch.setattr(minhash, "BLOCK", 32)
    monkeypatch.setattr(minhash, "TASKS", 1)
    monkeypatch.setattr(minhash, "TASK_VALUES", 1_000, raising=False)
    monkeypatch.setattr(minhash, "_block_links", bounded)
    found = reachable(range(n), [(r.a, r.b) for r in minhash.rest_links(member, sets).collect()])
    for i in range(n):  # places 0, 1 and 5 of every eight have one set
        assert found[i] == (i // 8 * 8 if i % 8 in (1, 5) else i)


def test_few_rows_of_a_batch_are_python_objects():
    import pyarrow as pa

    from rewardtables.llm.common import rows_of

    class Column:
        def __init__(self, values):
            self.values = values

        def __len__(self):
            return len(self.values)

        def slice(self, at, rows):
            return Column(self.values.slice(at, rows))

        def to_pylist(self):
            assert len(self.values) <= 256
            return self.values.to_pylist()

    a, b = pa.array(["x", None, ""] * 1_000), pa.array([[1], [], None] * 1_000)
    assert list(rows_of(Column(a), Column(b))) == list(zip(a.to_pylist(), b.to_pylist(), strict=True))
