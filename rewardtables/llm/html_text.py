"""Operator 10: main text of pages as the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. A word scores 1, or ``LOW`` if an element around it is of a
kind that holds little content; a tag scores below 0, the more so the less content its kind holds. One
linear scan finds the contiguous region of the greatest sum; its words outside low-content elements are the
text. In marked content (``article``, ``main``) low-content elements score 0, so what is behind them stays.

How much content a kind of element (tag name, or word of its class, id or role) holds is learnt
from labelled pages: those that mark their content by one ``article`` or ``main`` element. Their words inside
and outside are counted by kind, over at most ``LABELLED`` pages of smallest hash of page_id. An element's kinds
add up: learnt log-odds, and as a weak prior what conventional names lead to expect (``NAMES``, ``CONTENT``), which
learnt counts outvote. Names of marked content, and of what is around it, never count against it.

Scripts, styles, comments and other raw elements are no text. Character references are decoded.
Block tags and line breaks separate words, inline tags don't; all white space becomes
one space.

Nulls: null html gives the empty text; page_id and url pass through, null or not. Repeated rows
are extracted each for itself. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.llm.common import steps

LABELLED = 400
SMOOTH = 2.0
TAG_COST = 0.02
#: what a word of an element of little content costs, unless it lies in marked content, where it costs nothing
LOW = -0.5
#: learnt log-odds count up to this; an element is of little content at -1 or less
CLIP = 3.0
MARKED = frozenset(("article", "main"))
# fixed values: words of names that speak for content, and words that make a name say a state, not a part
CONTENT = frozenset("article body content copy entry main post story text".split())
STATES = frozenset("closed disabled enabled has is no open with".split())

# fixed values: names that pages commonly give to what is not content
NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements aside banner breadcrumb breadcrumbs button"
    " comment comments consent cookie cookies disclaimer dialog discussion footer form gdpr header"
    " input label login masthead menu modal nav navbar navigation newsletter notice notices"
    " pagination pager popup promo promoted promotion related replies reply responses select"
    " share sharing sidebar sidebars signup social sponsor sponsored subscribe toolbar widget".split()
)
RAW = "script|style|template|textarea|svg|iframe|title"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
HELD = frozenset(
    "article main section div nav header footer aside form ul ol dl table figure dialog"
    " details fieldset menu button select label blockquote head".split()
)
# of any content: known by their class, id and role only
PLAIN = frozenset("section div ul ol dl table figure details fieldset blockquote label".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?A-Za-z][^>]*>|[^<]+|<",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Za-z]+")


def names_of(attributes: str) -> list[str]:
    """The words of class, id and role; names of states (has-sidebar, comments-open) say nothing."""
    words: set[str] = set()
    for groups in _NAMED.findall(attributes):
        for name in "".join(groups).split():
            parts = [x.lower() for x in _PARTS.findall(name)]
            if len(parts) == 1 or not STATES.intersection(parts):
                words.update(parts)
    return sorted(words)


def events(page: str) -> Iterator[tuple[str, str, list[str] | int]]:
    """Texts, tags, and elements that open ("push", with the words that name them) and end ("pop", how many)."""
    around: list[str] = []
    held: Counter = Counter()
    for found in _TOKEN.finditer(page):
        name = found[3]
        if name is None:
            value = found[0]
            if value[0] != "<" or len(value) == 1:
                yield "text", value, 0
            elif found[1]:
                yield "tag", found[1].lower(), 0
            continue
        name = name.lower()
        if name == "body":
            yield "pop", name, len(around)
            around.clear()
            held.clear()
        elif name in HELD:
            if not found[2]:
                around.append(name)
                held[name] += 1
                keys = [] if name in PLAIN else [name]
                yield "push", name, keys + [k for k in names_of(found[4] or "") if k != name]
            elif held[name]:
                count = 0
                while True:
                    last = around.pop()
                    held[last] -= 1
                    count += 1
                    if last == name:
                        break
                yield "pop", name, count
        yield "tag", name, 0


def labelled_counts(page: str) -> Counter:
    """Words inside and outside the marked content, by kind of element around them."""
    counts: Counter = Counter()
    if len(re.findall(r"<(?:article|main)\b", page, re.I)) != 1:
        return counts
    # (kinds, marked, named like no content, words inside, words outside) of the open elements
    around: list[list] = []

    def end(n: int) -> None:
        for _ in range(n):
            keys, _, _, inside, outside = around.pop()
            for key in keys:
                counts[key, True] += inside
                counts[key, False] += outside
            if around:
                around[-1][3] += inside
                around[-1][4] += outside

    for kind, value, more in events(page):
        if kind == "push":
            marked = value in MARKED or bool(around) and around[-1][1]
            named = bool(around) and around[-1][2] or (value not in MARKED and bool(NAMES.intersection(more)))
            around.append([more, marked, named, 0, 0])
        elif kind == "pop":
            end(more)
        elif kind == "text" and around and (n := len(value.split())):
            around[-1][3 if around[-1][1] and not around[-1][2] else 4] += n
    end(len(around))
    return counts


def learn(pages: DataFrame) -> dict[str, float]:
    """Log-odds of content for every kind of element on labelled pages."""
    marked = pages.select("page_id", "html").where(F.col("html").rlike("(?i)<(article|main)\\b"))
    sample = marked.orderBy(F.xxhash64("page_id"), "page_id").limit(LABELLED)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for page in batch.column(1).to_pylist():
                total.update(labelled_counts(page))
            rows = [{"kind": k, "inside": i, "n": n} for (k, i), n in total.items()]
            kinds = pa.schema([("kind", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())])
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    counts = sample.mapInArrow(count, "kind string, inside boolean, n long")
    inside, outside = Counter(), Counter()
    for kind, is_in, n in counts.groupBy("kind", "inside").agg(F.sum("n")).collect():
        (inside if is_in else outside)[kind] += n
    return {
        kind: math.log((inside[kind] + SMOOTH) / (outside[kind] + SMOOTH))
        for kind in {*inside, *outside}
    }


def weight(key: str, learnt: dict[str, float]) -> float:
    """Content of a kind of element: learnt log-odds, and what its name leads to expect."""
    prior = -2.0 if key.startswith("comment") else -1.0 if key in NAMES else 1.0 if key in CONTENT else 0.0
    return prior + max(-CLIP, min(CLIP, learnt.get(key, 0.0)))


def extract(page: str | None, learnt: dict[str, float]) -> str:
    """Main text of one page."""
    scored: list[tuple[float, str | None]] = []
    # (marked, of little content, so by tag) of the open elements
    around: list[tuple[bool, bool, bool]] = []
    known: dict[str, float] = {}
    for kind, value, more in events(page or ""):
        marked, low, by_tag = around[-1] if around else (False, False, False)
        if kind == "push":
            if value in MARKED and not marked:
                # the names of marked content and of what is around it do not count against it
                around.append((True, by_tag, by_tag))
                continue
            words = [k for k in more if not (marked and k == "header")]  # the head of an article is content
            if sum(weight(k, learnt) for k in words) <= -1.0:
                low, by_tag = True, by_tag or value in NAMES
            around.append((marked, low, by_tag))
        elif kind == "pop":
            del around[len(around) - more :]
        elif kind == "tag":
            if value not in known:
                known[value] = TAG_COST * (2.0 if weight(value, learnt) < 0 else 1.0)
            scored.append((-known[value], "" if value in INLINE else " "))
        else:
            text = html.unescape(value) if "&" in value else value
            # what is low inside marked content is left out, but does not part it
            part = 1.0 if not low else 0.0 if marked else LOW
            scored.append((part * len(text.split()), " " if low else text))
    best, total, start, first, last = 0.0, 0.0, 0, 0, -1
    for i, (score, _) in enumerate(scored):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, first, last = total, start, i
    return " ".join("".join(text for _, text in scored[first : last + 1]).split())


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    learnt = learn(pages)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            out = [extract(page, learnt) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(out, pa.string()),
                    pa.array([len(x) for x in out], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        texts, "page_id long, url string, text string, n_chars long"
    )
