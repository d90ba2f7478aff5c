"""Text functions and rewards: golden rows, then random strings against Python's own methods."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from rewardtables.constants import PY_WHITESPACE
from rewardtables.functions import rewards, text


def apply(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i INT, t STRING")
    return [r["v"] for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_white_space_is_what_python_strips():
    every = "".join(c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and c.isspace())
    assert sorted(PY_WHITESPACE) == sorted(every)
    assert len(PY_WHITESPACE) == 29


@pytest.mark.parametrize(
    "given, expected",
    [
        ("<answer>\n 42\t</answer>", "42"),
        ("a</answer>b<answer>c", "c"),
        ("  no tags 　", "no tags"),
        ("<answer>1</answer><answer>2</answer>", "2"),
        ("<answer>open", "open"),
        ("x</answer>y", "x"),
        ("<answer></answer>", ""),
        ("", ""),
        (None, None),
    ],
)
def test_xml_answer(spark, given, expected):
    assert apply(spark, [given], text.xml_answer) == [expected]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("work\n#### 1,234", "1,234"),
        ("no mark", None),
        ("a ####b #### c", "b"),
        ("#####5", "#5"),
        ("####", ""),
        ("########9", ""),
        ("a ### b", None),
        (None, None),
    ],
)
def test_hash_answer(spark, given, expected):
    assert apply(spark, [given], text.hash_answer) == [expected]


@pytest.mark.parametrize(
    "given, expected",
    [("[INST] q [/INST] a ", "a"), ("x[/INST]y[/INST]\nz", "z"), (" plain\x1f", "plain")],
)
def test_after_marker(spark, given, expected):
    assert apply(spark, [given], text.after_marker) == [expected]


GOOD = "<reasoning>\nr\n</reasoning>\n<answer>\na\n</answer>\n"


@pytest.mark.parametrize(
    "given, expected",
    [
        (GOOD, 0.5),
        (GOOD + "\n", 0.5),
        (GOOD + "\n\n", 0.0),
        (GOOD[:-1], 0.0),
        (" " + GOOD, 0.0),
        (GOOD.replace("\nr\n", "\nr\ns\n"), 0.0),
        (GOOD.replace("r\n", "r\rs t\x85\n", 1), 0.5),
        (GOOD.replace("\na\n", "\n\n"), 0.5),
        (GOOD[:-1] + "\r\n", 0.0),
        (None, 0.0),
    ],
)
def test_strict_format(spark, given, expected):
    assert apply(spark, [given], rewards.strict_format) == [expected]


def test_length_counts_code_points(spark):
    values = ["", "x" * 20, "é😀", "x" * 30, None]
    assert apply(spark, values, rewards.length) == [-20.0, 0.0, -18.0, -10.0, None]
    assert apply(spark, ["abc"], lambda c: rewards.length(c, target=5)) == [-2.0]


def test_correctness_of_missing_values(spark):
    df = spark.createDataFrame([("<answer>1", None), (None, "1"), ("<answer> 1 ", "1"), ("1", "2")], "c STRING, a STRING")
    got = df.select(rewards.correctness(F.col("c"), F.col("a")).alias("r")).collect()
    assert [r["r"] for r in got] == [0.0, 0.0, 2.0, 0.0]


def test_message_contents(spark):
    df = spark.sql(
        "select array(named_struct('role','a','content','x'), named_struct('role','b','content','y')) m "
        "union all select cast(array() as array<struct<role:string,content:string>>)"
    )
    got = df.select(text.first_content(F.col("m")), text.last_content(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [("x", "y"), (None, None)]


def random_texts(n, seed):
    pieces = [
        "<answer>", "</answer>", "<reasoning>", "</reasoning>", "####", "#", "[/INST]", "\n", "\r",
        " ", "\t", "\x85", " ", "　", "\x1c", "​", "é", "😀", "7", "word", ",",
        "<reasoning>\n", "\n</reasoning>\n<answer>\n", "\n</answer>\n",
    ]
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_random_texts(spark):
    texts = random_texts(6000, 1)
    pattern = re.compile("<reasoning>\n[^\n]*\n</reasoning>\n<answer>\n[^\n]*\n</answer>\n\n?")
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    t = F.col("t")
    got = (
        df.select(
            "i", text.xml_answer(t).alias("x"), text.hash_answer(t).alias("h"),
            text.after_marker(t).alias("m"), rewards.strict_format(t).alias("f"),
            rewards.length(t).alias("l"),
        )
        .orderBy("i")
        .collect()
    )
    for s, row in zip(texts, got):
        assert row["x"] == s.rpartition("<answer>")[2].partition("</answer>")[0].strip()
        marked = s.split("####", 2)
        assert row["h"] == (marked[1].strip() if len(marked) > 1 else None)
        assert row["m"] == s.rpartition("[/INST]")[2].strip()
        assert row["f"] == (0.5 if pattern.fullmatch(s) else 0.0)
        assert row["l"] == -abs(20 - len(s))
    assert sum(r["f"] > 0 for r in got) >= 0


def test_rendered_text_round_trips(spark):
    lines = [s.replace("\n", " ") for s in random_texts(1500, 2)]
    clean = [s.replace("<answer>", "").replace("</answer>", "") for s in lines]
    df = spark.createDataFrame([(i, r, a) for i, (r, a) in enumerate(zip(lines, clean))], "i INT, r STRING, a STRING")
    rendered = text.render_cot(F.col("r"), F.col("a"))
    got = df.select("a", text.xml_answer(rendered).alias("x"), rewards.strict_format(rendered).alias("f")).collect()
    assert all(r["x"] == r["a"].strip() for r in got)
    assert all(r["f"] == 0.5 for r in got)
