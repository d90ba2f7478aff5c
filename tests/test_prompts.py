from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rewardtables.constants import RISK_SYSTEM_PROMPT, SYSTEM_PROMPT
from rewardtables.functions import chat
from rewardtables.operators import prompts


def test_prepare_qa_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "q?", "w #### 5 ")], "id INT, question STRING, answer STRING")
    row = prompts.prepare_qa(df).first()
    assert (row["id"], row["question"], row["answer"]) == (1, "q?", "5")
    assert [(m["role"], m["content"]) for m in row["prompt"]] == [("system", SYSTEM_PROMPT), ("user", "q?")]
    assert SYSTEM_PROMPT.startswith("\n") and SYSTEM_PROMPT.endswith("\n")


def test_render_chat(spark):
    df = spark.createDataFrame([("u",)], "t STRING")
    messages = prompts.chat_messages(F.col("t"), "s")
    body = "<|start_header_id|>system<|end_header_id|>\ns<|eot_id|><|start_header_id|>user<|end_header_id|>\nu<|eot_id|>"
    got = df.select(chat.render_chat(messages), chat.render_chat(messages, add_generation=False)).first()
    assert got[0] == body + "<|start_header_id|>assistant<|end_header_id|>\n"
    assert got[1] == body


def test_keep_last(spark):
    df = spark.sql("select array(1,2,3) a union all select array() union all select array(9)")
    assert [r[0] for r in df.select(chat.keep_last(F.col("a"), 2)).collect()] == [[2, 3], [], [9]]
    with pytest.raises(ValueError):
        chat.keep_last(F.col("a"), 0)


class _Letters:
    """A tokenizer with one token per character."""

    def encode_batch(self, texts):
        return [list(text) for text in texts]

    def decode_batch(self, ids):
        return ["".join(x) for x in ids]


def test_format_prompts(spark):
    df = spark.createDataFrame([(1, "a  b\nc"), (2, None)], "id INT, prompt STRING")
    whole = prompts.format_prompts(df, None, keep=("id",)).orderBy("id").collect()
    assert RISK_SYSTEM_PROMPT in whole[0]["prompt"] and "a  b\nc" in whole[0]["prompt"]
    assert whole[1]["prompt"] is None
    assert prompts.format_prompts(df, 2048).columns == ["prompt"]
    tail = prompts.format_prompts(df, max_tokens=2).first()["prompt"]
    assert tail == "b\nc<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n"
    plain = prompts.format_prompts(df, 2, render=lambda m: m[1]["content"]).first()["prompt"]
    assert plain == "b\nc"
    with pytest.raises(ValueError):
        prompts.format_prompts(df, 0)
    own = prompts.format_prompts(df, max_tokens=5, tokenizer=_Letters(), keep=("id",)).orderBy("id").collect()
    assert [r["prompt"] for r in own] == ["_id|>\n"[-5:], None]


def test_instruction_prompt(spark):
    rows = [(3, "c", "z"), (1, "a", "x"), (2, "b", None)]
    df = spark.createDataFrame(rows, "k INT, instruction STRING, input STRING")
    got = prompts.instruction_prompt(df, "k", limit=2).collect()
    assert [(r["k"], r["prompt"]) for r in got] == [(1, "a\nx"), (2, None)]
    assert prompts.instruction_prompt(df, "k").count() == 3


def test_cuts_where_the_nth_last_token_begins(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts += [None, "", " \n", "Ünïcode ÉTÉ  日本語 🙂 it's <|endoftext|> x", "a " * 3000, "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, prompt STRING").repartition(3)
    for n in (1, 3, 40):
        tokenizer = prompts.FileTokenizer(path, characters=5_000)
        got = prompts.format_prompts(df, n, tokenizer=tokenizer, render=lambda m: m[1]["content"], keep=("id",))
        for row in got.collect():
            text = texts[row.id]
            if text is None:
                assert row.prompt is None
                continue
            code = whole.encode(text, add_special_tokens=False)
            assert row.prompt == (text[code.offsets[-n][0] :] if len(code) > n else text)
            if len(code) > n:  # what is left has the kept tokens, or a word's part that is cut anew
                assert len(whole.encode(row.prompt, add_special_tokens=False)) >= 1


def test_the_end_of_a_text_is_enough_or_not(spark):
    from rewardtables.functions.chat import last_tokens

    texts = ["a b c", "a " * 50, "word " * 9 + "x" * 500, "  lead " + "y" * 300 + " tail \n", " " * 400 + "one two three four", "x" * 400]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for n in (1, 2, 3, 7):
        for row in df.select("t", last_tokens(F.col("t"), n).alias("got")).collect():
            places = [m.start() for m in re.finditer(r"[^ \t\n\x0b\f\r]+", row.t)]
            assert row.got == (row.t[places[-n] :] if len(places) > n else row.t)


def test_query_of_the_word_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from rewardtables.functions.chat import render_chat
    from rewardtables.plans import catalog

    small = "/root/testdata/sf0.001"
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r.doc_id: r.c for r in docs.select("doc_id", render_chat(prompts.chat_messages(F.col("text"), RISK_SYSTEM_PROMPT)).alias("c")).collect()}
    got = catalog.word_tokenizer_tail(spark, small).collect()
    assert len(got) == len(want)
    for row in got:
        code = whole.encode(want[row.doc_id], add_special_tokens=False)
        assert row.prompt == (want[row.doc_id][code.offsets[-2048][0] :] if len(code) > 2048 else want[row.doc_id])


class FewAtOnce:
    """Places of a tokenizer of letters that takes few texts at a time."""

    def tail_starts(self, texts, n):
        assert len(texts) <= prompts.TEXTS_PER_STEP, len(texts)
        return [max(0, len(t) - n) for t in texts]


def test_a_worker_holds_few_texts_of_a_long_batch(spark):
    rows = [(i, None if i % 7 == 0 else "" if i % 7 == 1 else "x" * (i % 50) + str(i)) for i in range(1_000)]
    df = spark.createDataFrame(rows, "id INT, prompt STRING").coalesce(1)
    plain = lambda messages: messages[1]["content"]
    got = prompts.format_prompts(df, 10, tokenizer=FewAtOnce(), render=plain, keep=("id",)).collect()
    assert {r.id: r.prompt for r in got} == {i: t and t[-10:] for i, t in rows}
    assert len(got) == 1_000
