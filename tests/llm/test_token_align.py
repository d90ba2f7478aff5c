"""Operator 13 against whole encodings and a dictionary of all links."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rewardtables.llm import queries, token_align

from .helpers import ODD_TEXTS, documents

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sides():
    path_a, path_b = token_align.tokenizer_paths()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=path_b)


@pytest.fixture(scope="module")
def aligner():
    return token_align.Aligner.of(token_align.tokenizer_paths())


def tokens(sides, aligner, text):
    """(ids of A, ids of B) of a whole text, or None."""
    if not text:
        return None
    a = sides[0].encode(" " + text, add_special_tokens=False).ids
    b = sides[1].encode(text)
    raw = (" " + text).encode()
    same = [b"".join(names[i] for i in ids) == raw for names, ids in ((aligner._bytes_a, a), (aligner._bytes_b, b))]
    return (a, b) if all(same) else None


def spans(ids, names):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(names[i]), i))
        at += len(names[i])
    return out


def brute(rows, sides, aligner):
    """All rows of the result by comparing every A with every B token of a text."""
    links, told = [], []
    for name, text in rows:
        found = tokens(sides, aligner, text)
        if found is None:
            links.append([])
            told.append((name, 0, 0, 0, ""))
            continue
        a, b = spans(found[0], aligner._bytes_a), spans(found[1], aligner._bytes_b)
        if len(a) * len(b) < 1_000_000:
            links.append([(y[2], x[2]) for x in a for y in b if max(x[0], y[0]) < min(x[1], y[1])])
        else:  # neighbours only
            near, j = [], 0
            for x in a:
                while b[j][1] <= x[0]:
                    j += 1
                k = j
                while k < len(b) and b[k][0] < x[1]:
                    near.append((b[k][2], x[2]))
                    k += 1
            links.append(near)
        ends = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, i, j = [], 0, 0
        for end in ends:
            ga, gb = [], []
            while i < len(a) and a[i][1] <= end:
                ga.append(str(a[i][2]))
                i += 1
            while j < len(b) and b[j][1] <= end:
                gb.append(str(b[j][2]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        told.append((name, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for doc in links for p in doc)
    highest = defaultdict(int)
    for (b, _), n in count.items():
        highest[b] = max(highest[b], n)
    return [
        (*t[:4], len(doc), sum(count[p] == highest[p[0]] for p in doc), sum(count[p] for p in doc), t[4])
        for t, doc in zip(told, links, strict=True)
    ]


def same(df, want):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


MORE = [
    (20, "it's  two\n spaces,\tand a tab \n"),
    (21, "‖ odd ▁ mark"),
    (22, "</s> [INST] <unk> <0x41>"),
    (23, " "),
    (24, "café́ \x00 日本 🙂🙂 naïve"),
    (25, "tail "),
    (26, "a" * 3000),
]


def test_chunks_are_aligned_as_whole_texts(sides, aligner):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab  \n\t.'s1é中▁\xa0\x1c\x85 🙂", k=rng.randint(1, 30))) for _ in range(4000)]
    texts += [f"a{chr(c)} b {chr(c)} {chr(c)}{chr(c)}1 x{chr(c)}" for c in range(1, 0x800)]
    for text, entries in zip(texts, aligner.align(texts), strict=True):
        found = tokens(sides, aligner, text)
        got = [g.split("|") for e in entries for g in e[3].decode().split(";")]
        a, b = ([int(i) for g in got for i in g[side].split(",")] for side in (0, 1))
        assert (found or ([], [])) == (a, b)


@pytest.mark.parametrize("records,fan", [(token_align.RECORDS, token_align.FAN), (40, 2)])
def test_documents(spark, sides, aligner, records, fan):
    rows = ODD_TEXTS + MORE
    got = token_align.token_alignment(documents(spark, rows), records=records, fan=fan)
    same(got, brute(rows, sides, aligner))


def test_tables_without_tokens(spark):
    assert token_align.token_alignment(documents(spark, [])).collect() == []
    got = token_align.token_alignment(documents(spark, [(1, None), (1, ""), (None, None)])).collect()
    assert sorted(tuple(r)[1:] for r in got) == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_query(spark, sides, aligner):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    same(queries.op13_token_alignment(spark, SMALL), brute(docs, sides, aligner))


def test_heap_merge():
    rng = np.random.default_rng(2)
    runs, want = [], Counter()
    for _ in range(9):
        keys = np.unique(rng.integers(0, 500, rng.integers(0, 300)))
        totals = rng.integers(1, 9, len(keys))
        want.update(dict(zip(keys.tolist(), totals.tolist(), strict=True)))
        runs.append((keys, totals))
    for block in (1, 7, 1000):
        parts = list(token_align.heap_merged(runs, block))
        keys = np.concatenate([k for k, _ in parts]).tolist()
        assert keys == sorted(want)
        assert dict(zip(keys, np.concatenate([t for _, t in parts]).tolist(), strict=True)) == dict(want)
    values = rng.integers(-(2**62), 2**62, 1000)
    assert token_align.unpack(token_align.pack(values)).tolist() == values.tolist()
