"""Operators 2 and 8 against whole texts and brute force."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from rewardtables.llm import packing, queries, token_codes
from rewardtables.llm.encoding import WordEncoder, tokenizer_path

from .helpers import ODD_TEXTS, documents


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokenizer_path())


def test_words_give_the_ids_of_whole_texts(spark, sf_dir, whole):
    texts = [t or "" for _, t in ODD_TEXTS]
    texts += ["".join(random.Random(i).choices("aB'st 9.,é́İΣß <|>\n中", k=60)) for i in range(400)]
    texts += [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for text, ids in zip(texts, WordEncoder(tokenizer_path()).encode_many(texts, 7), strict=True):
        assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, 7]


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.choice([0, 255, 256, 49407, 70000, 2**32 - 1], n).astype(np.uint32)
        codes = token_codes.Codes(token_codes.encode_codes(ids))
        assert codes.slice(0, n).tolist() == ids.tolist()
        for i in rng.integers(0, n, 50).tolist() if n else []:
            assert codes.get(i) == ids[i]
            assert codes.slice(i, min(n, i + 700)).tolist() == ids[i : i + 700].tolist()
    with pytest.raises(IndexError):
        token_codes.Codes(token_codes.encode_codes(np.array([1]))).get(1)


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def test_token_files(spark, whole):
    got = token_codes.token_codes(documents(spark)).collect()
    rows = sorted(ODD_TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for name, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((name, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_codes.token_codes(documents(spark, [])).collect() == []


def test_token_files_of_the_table(spark, sf_dir, whole):
    start = 0
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op8_token_codes(spark, sf_dir).orderBy("doc_id").collect()
    for row, doc in zip(got, texts, strict=True):
        ids = [*whole.encode(doc.text, add_special_tokens=False).ids, 2]
        assert tuple(row) == (doc.doc_id, start, len(ids), crc(ids))
        start += len(ids)


def assert_packed(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_of_odd_rows(spark, whole):
    got = packing.pack_documents(documents(spark)).collect()
    assert_packed(got, 4096)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for name, text in ODD_TEXTS:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for n, first in enumerate(range(0, len(ids), 4096)):
            part = ids[first : first + 4096]
            assert (n, first, len(part), crc(part)) in pieces[name]
    assert packing.pack_documents(documents(spark, [])).collect() == []


def test_packing_of_the_table_is_tight(spark, sf_dir):
    got = queries.op2_best_fit_packing(spark, sf_dir).collect()
    n = assert_packed(got, 4096)
    assert n <= 1.01 * sum(r.length for r in got) / 4096 + 1


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= length]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


def test_sweeps_are_near_sequential_best_fit():
    rng = np.random.default_rng(5)
    for draw in (
        lambda: rng.integers(1, 101, 400),
        lambda: np.full(400, 34),
        lambda: rng.choice([51, 50, 49, 26, 25], 400),
        lambda: np.minimum(100, rng.lognormal(2.5, 1, 600).astype(int) + 1),
    ):
        lengths = draw().tolist()
        counts = {x: lengths.count(x) for x in set(lengths)}
        runs = packing.sweep_runs(counts, 100)
        placed = {x: 0 for x in counts}
        used = defaultdict(list)
        for length, first, n, seq, offset in runs:
            assert first == placed[length]
            placed[length] += n
            for i in range(n):
                used[seq + i].append((offset, length))
        assert placed == counts
        for held in used.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= 100
        assert len(used) <= 1.03 * best_fit_decreasing(lengths, 100) + 1
