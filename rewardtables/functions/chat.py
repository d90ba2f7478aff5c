"""Chat rendering and token-tail truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: header and end-of-turn tokens of the fallback chat template
_HEAD_OPEN = "<|start_header_id|>"
_HEAD_CLOSE = "<|end_header_id|>\n"
_END_OF_TURN = "<|eot_id|>"

_ASCII_SPACES = " \t\n\x0b\f\r"
_SPACES = "[ \\t\\n\\x0B\\f\\r]+"
_TOKEN = "[^ \\t\\n\\x0B\\f\\r]+"
_NEAR = 12


def render_chat(messages: Column, add_generation: bool = True) -> Column:
    """Render a message list as one string, optionally opening the assistant turn.

    A message without role or content makes the whole NULL, rather than vanish.
    """
    turns = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(_HEAD_OPEN), m["role"], F.lit(_HEAD_CLOSE), m["content"], F.lit(_END_OF_TURN)
        ),
    )
    body = F.when(~F.exists(turns, lambda t: t.isNull()), F.array_join(turns, ""))
    if not add_generation:
        return body
    return F.concat(body, F.lit(_HEAD_OPEN + "assistant" + _HEAD_CLOSE))


def whitespace_tokens(text: Column) -> Column:
    """Runs of characters other than ASCII white space; empty for a blank text."""
    bare = F.btrim(text, F.lit(_ASCII_SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _SPACES))


def keep_last(tokens: Column, n: int) -> Column:
    """The last ``n`` elements; the array itself when it is not longer than ``n``."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return F.when(F.size(tokens) <= n, tokens).otherwise(F.slice(tokens, -n, n))


def last_tokens(text: Column, n: int) -> Column:
    """The text from its n-th last token on, white space and all; shorter texts stay untouched.

    Texts of up to 2 n characters have no more tokens than n. Of longer ones the last ``_NEAR`` n characters are
    looked at first; only if these have too few tokens the whole text is cut up.
    """
    if n < 1:
        raise ValueError("n must be at least 1")

    def cut(c: Column) -> Column:
        tokens = F.slice(whitespace_tokens(c), -n, n)
        gaps = F.slice(F.split(c, _TOKEN), -n, n)  # behind each of these tokens
        return F.right(c, F.length(F.array_join(tokens, "")) + F.length(F.array_join(gaps, "")))

    near = F.right(text, F.lit(_NEAR * n))
    count = lambda c: F.regexp_count(c, F.lit(_TOKEN))
    # the first token of the end may be a part of one: there must be one more
    return (
        F.when(F.length(text) <= 2 * n, text)
        .when(count(near) > n, cut(near))
        .when(count(text) <= n, text)
        .otherwise(cut(text))
    )
