"""Operator 6: chat formatting with Spark expressions.

A run of turns of one role is ``<s>role``, a line feed, the texts with ``<sep>`` between them,
``</s>``. In roles and texts a backslash becomes ``\\e``, ``<`` becomes ``\\l``, ``[`` becomes ``\\b``,
and in roles a line feed becomes ``\\n``, so that no control string is left and every text
can be read back. Turns of a conversation are collected in blocks of ``BLOCK`` turn numbers first, then
block by block, sorted and merged.

``loss_runs`` is the loss mask: lengths in characters of what is not and what is learnt, in turn,
over the whole of ``formatted``; the texts of assistants are learnt, markers are not. The learnt text
is read back by that mask, in Arrow batches, as cutting by offsets is linear there.

Nulls: a null text or role is empty; a null turn comes first; rows of null conv_id form one
conversation. Turns of equal number are sorted by role and text; repeated rows are kept. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardtables.llm.common import steps
from rewardtables.sources.scratch import staged

BLOCK = 64
OPEN, SEP, CLOSE = "<s>", "<sep>", "</s>"
LEARNT = "assistant"


def _swap(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


_TEXT = [("\\", "\\e"), ("<", "\\l"), ("[", "\\b")]
_ROLE = [*_TEXT, ("\n", "\\n")]


def escape(text: Column, pairs: list[tuple[str, str]] = _TEXT) -> Column:
    """Replace what could begin a control string; the backslash first."""
    return _swap(text, pairs)


def unescape(text: Column, pairs: list[tuple[str, str]] = _TEXT) -> Column:
    """Undo ``escape``; the backslash last."""
    return _swap(text, [(new, old) for old, new in reversed(pairs)])


def collected(turns: DataFrame) -> DataFrame:
    """One row per conversation with its sorted turns."""
    rows = turns.select(
        "conv_id",
        F.floor(F.col("turn") / BLOCK).alias("block"),
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    blocks = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = blocks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "turns"))).alias("blocks")
    )
    return whole.select("conv_id", F.flatten("blocks.turns").alias("turns"))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_runs."""
    chats = collected(turns)
    shifted = chats.select(
        "conv_id",
        "turns",
        F.concat(F.array(F.lit(None).cast("string")), F.slice("turns.role", 1, F.size("turns") - 1)).alias("before"),
    )
    # (marker, text, learnt) of every turn; a turn of the role before it goes on with its run
    segments = shifted.select(
        "conv_id",
        F.zip_with(
            "turns",
            "before",
            lambda t, b: F.struct(
                F.when(t["role"].eqNullSafe(b), F.lit(SEP))
                .otherwise(
                    F.concat(F.when(b.isNull(), "").otherwise(CLOSE), F.lit(OPEN), escape(t["role"], _ROLE), F.lit("\n"))
                )
                .alias("marker"),
                escape(t["text"]).alias("text"),
                (t["role"] == LEARNT).alias("learnt"),
            ),
        ).alias("segments"),
    )
    body = F.array_join(F.transform("segments", lambda s: F.concat(s["marker"], s["text"])), "")
    runs = F.flatten(
        F.transform(
            "segments",
            lambda s: F.when(s["learnt"], F.array(F.length(s["marker"]), F.length(s["text"]))).otherwise(
                F.array(F.length(s["marker"]) + F.length(s["text"]), F.lit(0))
            ),
        )
    )
    return segments.select(
        "conv_id",
        F.concat(body, F.lit(CLOSE)).alias("formatted"),
        F.concat(runs, F.array(F.lit(len(CLOSE)), F.lit(0))).alias("loss_runs"),
    )


def parsed(formatted: Column) -> Column:
    """Turns (role, text) of formatted conversations."""
    runs = F.array_remove(F.split(formatted, CLOSE), "")
    role = lambda r: F.substring_index(F.substr(r, F.lit(len(OPEN) + 1)), "\n", 1)
    body = lambda r: F.substr(r, F.instr(r, "\n") + 1)
    return F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(
                F.split(body(r), SEP),
                lambda t: F.struct(unescape(role(r), _ROLE).alias("role"), unescape(t).alias("text")),
            ),
        )
    )


def learnt_text(formatted: str, loss_runs: list[int]) -> str:
    """What the loss mask marks, unescaped."""
    parts, at = [], 0
    for skip, size in zip(loss_runs[::2], loss_runs[1::2], strict=True):
        parts.append(formatted[at + skip : at + skip + size])
        at += skip + size
    text = "".join(parts)
    for new, old in reversed(_TEXT):
        text = text.replace(old, new)
    return text


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        texts, runs = (batch.column(c).to_pylist() for c in ("formatted", "loss_runs"))
        learnt = [learnt_text(t, r) for t, r in zip(texts, runs, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv_id", "n_turns", "turns_sha256")),
                pa.array([len(t) for t in learnt], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in learnt], pa.string()),
                batch.column("formatted_chars"),
            ],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns, from the formatted strings, and of what the loss mask cuts out of them."""
    turns = formatted.select("conv_id", "formatted", "loss_runs", parsed(F.col("formatted")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = turns.select(
        "conv_id",
        "formatted",
        "loss_runs",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    conv = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(
        _masked,
        f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def chat_digests(turns: DataFrame) -> DataFrame:
    """Format all conversations, write them, read them back."""
    return read_back(staged(format_chats(turns), "chats"))
