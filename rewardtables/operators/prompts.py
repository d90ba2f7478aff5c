"""Prompt preparation."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardtables.constants import RISK_SYSTEM_PROMPT, SYSTEM_PROMPT
from rewardtables.functions.chat import last_tokens, render_chat
from rewardtables.functions.text import hash_answer, message

#: texts that a worker handles at once
TEXTS_PER_STEP = 64


def chat_messages(user: Column, system_prompt: str = SYSTEM_PROMPT) -> Column:
    """A system message followed by one user message."""
    return F.array(message("system", F.lit(system_prompt)), message("user", user))


def prepare_qa(
    df: DataFrame,
    system_prompt: str = SYSTEM_PROMPT,
    question: str = "question",
    answer: str = "answer",
) -> DataFrame:
    """Add the chat ``prompt`` and replace ``answer`` by the gold answer; other columns stay."""
    return df.withColumns(
        {
            "prompt": chat_messages(F.col(question), system_prompt),
            answer: hash_answer(F.col(answer)),
        }
    )


class Tokenizer(Protocol):
    """What a caller's tokenizer must do: whole lists at once, without special tokens."""

    def encode_batch(self, texts: list[str]) -> list[list]: ...

    def decode_batch(self, ids: list[list]) -> list[str]: ...


class FileTokenizer:
    """The tokenizer of a file in the format of the tokenizers library, opened once per worker.

    It tells places instead of texts: a prompt is cut where its n-th last token begins, so what is
    left is a part of the prompt, letter by letter, whatever the tokenizer would decode.
    """

    _open: dict[str, object] = {}

    def __init__(self, path: str, characters: int = 1_000_000) -> None:
        self.path, self.characters = path, characters

    def _file(self):
        if self.path not in self._open:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer as Opened

            opened = Opened.from_file(self.path)
            opened.no_truncation()
            opened.no_padding()
            self._open[self.path] = opened
        return self._open[self.path]

    def tail_starts(self, texts: list[str], n: int) -> list[int]:
        """The character at which the n-th last token of each text begins; 0 for texts of no more tokens.

        Texts are encoded whole, some ``characters`` at a time.
        """
        starts, held, size = [], [], 0
        for i, text in enumerate(texts):
            held.append(text)
            size += len(text)
            if size >= self.characters or i == len(texts) - 1:
                for code in self._file().encode_batch(held, add_special_tokens=False):
                    starts.append(code.offsets[-n][0] if len(code) > n else 0)
                held, size = [], 0
        return starts


def _arrow_places(tokenizer: FileTokenizer, max_tokens: int):
    """Texts cut at places of the tokenizer; those too short for so many tokens are not encoded.

    A token stands for a byte at least, and normal forms and small letters make no text five times as long.
    A worker holds ``TEXTS_PER_STEP`` texts at a time, however long Spark's batches are.
    """

    @F.arrow_udf("string")
    def tail(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for at in range(0, len(batch), TEXTS_PER_STEP):
                texts = batch.slice(at, TEXTS_PER_STEP).to_pylist()
                long = [i for i, t in enumerate(texts) if t is not None and 5 * len(t.encode()) > max_tokens]
                if long:
                    starts = tokenizer.tail_starts([texts[i] for i in long], max_tokens)
                    for i, start in zip(long, starts, strict=True):
                        texts[i] = texts[i][start:]
                yield pa.array(texts, pa.string())

    return tail


def _arrow_tail(tokenizer: Tokenizer, max_tokens: int):
    """One encode and one decode call per Arrow batch; only texts that are too long change."""

    @F.pandas_udf("string")
    def tail(texts: pd.Series) -> pd.Series:
        present = texts[texts.notna()]
        ids = pd.Series(tokenizer.encode_batch(present.tolist()), index=present.index, dtype=object)
        long = ids[ids.map(len) > max_tokens]
        out = texts.copy()
        if len(long):
            out[long.index] = tokenizer.decode_batch([x[-max_tokens:] for x in long])
        return out

    return tail


def format_prompts(
    df: DataFrame,
    max_tokens: int | None,
    system_prompt: str = RISK_SYSTEM_PROMPT,
    tokenizer: Tokenizer | FileTokenizer | None = None,
    render: Callable[[Column], Column] = render_chat,
    prompt: str = "prompt",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Render system and user message and keep the last ``max_tokens`` tokens, None for all.

    Returns ``prompt`` (and the columns named in ``keep``). Tokens are white-space
    separated, and what is kept of a text keeps its white space, unless a tokenizer is given; a
    ``FileTokenizer`` cuts the text where its n-th last token begins, others decode the ids they keep.
    ``render`` turns the message list into a string; a tokenizer's own chat template goes
    there.
    """
    if max_tokens is not None and max_tokens < 1:
        raise ValueError("max_tokens must be at least 1")
    rendered = render(chat_messages(F.col(prompt), system_prompt))
    df = df.select(*keep, rendered.alias("__chat"))
    out = F.col("__chat")
    if max_tokens is not None:
        if tokenizer is None:
            out = last_tokens(out, max_tokens)
        elif hasattr(tokenizer, "tail_starts"):
            out = _arrow_places(tokenizer, max_tokens)(out)
        else:
            out = _arrow_tail(tokenizer, max_tokens)(out)
    return df.select(*keep, out.alias("prompt"))


def instruction_prompt(
    df: DataFrame,
    order_key: str | None = None,
    limit: int | None = None,
    instruction: str = "instruction",
    input: str = "input",
) -> DataFrame:
    """Add ``prompt`` = instruction, line feed, input.

    Every row is taken, or the first ``limit`` by ``order_key``: a top-k over the key,
    without a full sort. Without a key column see ``sources.positions.first_rows``.
    """
    if limit is not None:
        if order_key is None:
            raise ValueError("the first rows need a key")
        df = df.orderBy(order_key).limit(limit)
    return df.withColumn("prompt", F.concat(F.col(instruction), F.lit("\n"), F.col(input)))
