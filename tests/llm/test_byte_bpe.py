"""Operator 11 against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import pytest
import tiktoken

from rewardtables.llm import byte_bpe, queries

from .helpers import ODD_TEXTS, documents

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(byte_bpe.rank_path())
    return tiktoken.Encoding("own", pat_str=byte_bpe.word_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe.of(byte_bpe.rank_path(), byte_bpe.word_pattern())


def test_ids_of_every_character_class(library, bpe):
    marks = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1 {chr(c)}  x" for c in marks]
    assert [x.tolist() for x in bpe.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_ids_and_bytes_of_random_and_long_words(library, bpe):
    rng = random.Random(1)
    texts = ["x" * n for n in (1, 2, 3, 7, 9, 30_000)] + [" " * 5000, "ab" * 5000, "\n" * 777, "=-" * 3000, ""]
    texts += ["".join(rng.choices("ab", k=5000)), "".join(rng.choices("aeioust", k=3000))]
    for alphabet, n in (("the in", 400), ("theinrsa", 60), ("aeb=- ", 100), ("é中 🙂x", 50)):
        texts += ["".join(rng.choices(alphabet, k=n)) for _ in range(500)]
    coded = bpe.encode(texts)
    assert [x.tolist() for x in coded] == [library.encode_ordinary(t) for t in texts]
    assert bpe.decode(coded) == [t.encode() for t in texts]


def test_rounds_that_start_again(library, bpe):
    words = [b"internationalisation", b"x" * 40, b"qwzjkvbnm" * 20]
    for rounds in (1, 2, 5):
        got = bpe.merge_long(words, rounds)
        assert [x.tolist() for x in got] == [brute_merge(w, bpe._ranks) for w in words]


def brute_merge(word, ranks):
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_ranks_that_fall_while_merging(tmp_path):
    """Vocabularies in which a contraction brings a pair of lesser rank beside it."""
    import base64

    rng = random.Random(5)
    for turn in range(6):
        tokens = [bytes([i]) for i in range(256)]
        extra = {"".join(rng.choices("abc", k=rng.randint(2, 5))).encode() for _ in range(60)}
        extra = rng.sample(sorted(extra), len(extra))
        path = tmp_path / f"{turn}.tiktoken"
        path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens + extra)))
        small = byte_bpe.ByteBpe(str(path), byte_bpe.word_pattern())
        words = ["".join(rng.choices("abc", k=rng.randint(1, 40))).encode() for _ in range(1500)]
        want = [brute_merge(w, small._ranks) for w in words]
        assert [x.tolist() for x in small.merge(words)] == want
        assert [x.tolist() for x in small.merge_long(words)] == want


def digest(raw):
    return hashlib.sha256(raw).hexdigest()


def expected(library, name, text):
    ids = library.encode_ordinary(text or "")
    return name, len(ids), digest(" ".join(map(str, ids)).encode()), digest((text or "").encode())


def test_documents(spark, library):
    got = byte_bpe.byte_bpe(documents(spark)).collect()
    back = byte_bpe.decode(byte_bpe.encode(documents(spark))).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(map(tuple, byte_bpe.recode(documents(spark)).collect()), key=repr)
    assert sorted(map(tuple, got), key=repr) == sorted((expected(library, *r) for r in ODD_TEXTS), key=repr)
    assert byte_bpe.byte_bpe(documents(spark, [])).collect() == []


def test_unknown_ids_are_refused(bpe):
    import numpy as np

    with pytest.raises(ValueError):
        bpe.decode([np.array([5, 60_000])])


def test_query(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_byte_bpe(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(expected(library, *r) for r in docs)
