"""Operators 3, 5, 6, 7, 9 and 10 on small rows against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest

from rewardtables.llm import chat_format, decontaminate, html_text, places, quality, substring, suffix_dedup
from rewardtables.llm.places import _planes, _unplanes, window_minima
from rewardtables.llm.suffixes import suffix_array

from .helpers import documents


def test_suffix_arrays():
    for seed in range(600):
        r = random.Random(seed)
        s = [r.randrange(r.choice([1, 2, 3, 26])) for _ in range(r.randrange(60))]
        if seed % 3 == 0:
            s = (s[:7] * 9)[: len(s)]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_window_minima_and_planes():
    rng = np.random.default_rng(0)
    for width in (1, 2, 8, 27):
        for n in (0, 1, 26, 27, 28, 90):
            h = rng.integers(1, 40, n).astype(np.uint64)
            want = np.zeros(n, dtype=bool)
            w = min(width, n)
            for i in range(n - w + 1 if n else 0):
                want[i : i + w] |= h[i : i + w] == h[i : i + w].min()
            assert (window_minima(h, width) == want).all()
    for values in ([], [5], [3, -2, 10**12, -(10**15)]):
        assert _unplanes(_planes(np.array(values, dtype=np.int64)), len(values)).tolist() == values


def plain_repeats(rows):
    out = set()
    for name, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - 49):
            if name is not None and any(
                n is not None and n < name and raw[i : i + 50] in (t or "").encode() for n, t in rows
            ):
                gone[i : i + 50] = [True] * 50
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall("1+", "".join("01"[g] for g in gone)))
        out.add((name, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def repeated_rows():
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdeé ", k=r.randrange(2, 9)))
    passages = ["".join(word() for _ in range(k)) for k in (8, 10, 12, 20, 60)]
    rows = []
    for name in range(60):
        parts = [word() for _ in range(r.randrange(3, 40))]
        for p in r.choices(passages, k=r.randrange(0, 4)):
            parts.insert(r.randrange(len(parts)), p[r.randrange(3) :])
        rows.append((name, "".join(parts)))
    line = "a line of fifty-five bytes that many documents will hold"
    rows += [(100 + i, f"{i * 7919} {line} {i * 104729}") for i in range(40)]
    rows += [(200, "a" * 700), (201, "a" * 300), (202, "ab" * 200), (203, rows[3][1]), (204, "short"), (205, "short")]
    rows += [(206, None), (207, ""), (None, rows[4][1]), (208, "x" * 49), (209, "x" * 50), (210, "x" * 50)]
    rows += [(3, rows[5][1] + " and more"), (3, rows[3][1])]
    return rows


def test_repeated_strings(spark, monkeypatch):
    rows = repeated_rows()
    want = plain_repeats(rows)
    got = suffix_dedup.suffix_dedup(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert set(map(tuple, got)) == want
    monkeypatch.setattr(suffix_dedup, "MANY", 2)  # nearly all anchors are spread
    assert set(map(tuple, suffix_dedup.suffix_dedup(documents(spark, rows)).collect())) == want
    monkeypatch.setattr(suffix_dedup, "FEW_ROWS", 0)  # spans are joined by a shuffle
    assert set(map(tuple, suffix_dedup.suffix_dedup(documents(spark, rows)).collect())) == want
    assert suffix_dedup.suffix_dedup(documents(spark, [])).collect() == []


def test_texts_without_repeats_keep_columns(spark):
    rows = [(1, "é" * 60), (2, "x" + "é" * 60), (3, None)]
    df = documents(spark, rows)
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "é" * 60, 2: "x", 3: None}


def plain_hits(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for name, item in items:
        v = words(item)
        n = min(13, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == v[i : i + n]:
                    hit.update(range(p, p + n))
                    if name is not None:
                        found.add(str(name))
    names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), names, bool(hit) and 20 * len(hit) >= len(w)


def test_contamination(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "the", "the"]
    items = [(i, " ".join(r.choices(words, k=k))) for i, k in enumerate((1, 2, 3, 5, 12, 13, 14, 40, 60))]
    items += [(20, None), (21, ""), (22, "..."), (23, items[7][1]), (None, items[5][1]), (10, "the"), (10, items[8][1])]
    rows = []
    for name in range(60):
        parts = r.choices(words, k=r.randrange(0, 80))
        item = (r.choice(items[:9])[1] or "").split()
        cut = item[r.randrange(3) :] if r.random() < 0.5 else item
        parts[5:5] = [x.upper() if x != "é" else x for x in cut]
        rows.append((name, ", ".join(parts)))
    rows += [(70, None), (71, ""), (None, items[7][1]), (72, items[7][1]), (72, "other words"), (72, "other words")]
    rows += [(73, "w1 " * 5000)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS wid", "1 AS n")
    got = decontaminate.decontaminate(documents(spark, rows), bench).drop("text_hash").collect()
    assert len(got) == len(rows)
    assert {tuple(x) for x in got} == {(n, *plain_hits(t, items)) for n, t in rows}
    empty = decontaminate.decontaminate(documents(spark, rows), bench.where("false")).collect()
    assert len(empty) == len(rows) and not any(x.contaminated for x in empty)
    assert decontaminate.decontaminate(documents(spark, []), bench).collect() == []


def test_decontamination_is_native(spark):
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    out = decontaminate.decontaminate(documents(spark), bench)
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_chats_round_trip(spark):
    control = "</s>[INST] ok [/INST]"
    odd = ["", None, control, "a\\e\\l\\b\\\\n<sep><s>x\n", "🙂é\\", "[<\\"]
    r = random.Random(5)
    rows = [
        (c, t, r.choice(["user", "assistant", "assistant", "sys<tem\n", None]), r.choice(odd))
        for c in (1, 2, 3, None)
        for t in range(200 if c == 1 else 7)
    ]
    rows += [(4, None, "assistant", "late"), (4, 0, "assistant", "b"), (4, 0, "assistant", "a"), (4, 0, "assistant", "a")]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS block", "1 AS t")
    formatted = chat_format.format_chats(df.repartition(3)).collect()
    got = {x.conv_id: x for x in chat_format.chat_digests(df.repartition(4)).collect()}
    order = lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")
    for chat in formatted:
        turns = sorted((x for x in rows if x[0] == chat.conv_id), key=order)
        turns = [(x[2] or "", x[3] or "") for x in turns]
        learnt = "".join(t for role, t in turns if role == "assistant")
        x = got[chat.conv_id]
        assert x.n_turns == len(turns)
        assert x.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (x.loss_chars, x.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        assert x.formatted_chars == len(chat.formatted) == sum(chat.loss_runs)
        at, masked = 0, []
        for skip, size in zip(chat.loss_runs[::2], chat.loss_runs[1::2], strict=True):
            masked.append(chat.formatted[at + skip : at + skip + size])
            at += skip + size
        text = "".join(masked).replace("\\b", "[").replace("\\l", "<").replace("\\e", "\\")
        assert text == learnt
        marks = chat.formatted.count("<s>") + chat.formatted.count("<sep>")
        assert marks == len(turns)
    assert chat_format.chat_digests(df.where("false")).collect() == []


def test_learnt_text_follows_the_mask(spark):
    rows = [(1, "<s>user\na\\lb</s><s>assistant\nc\\ed</s>", [29, 4, 4, 0])]
    right = spark.createDataFrame(rows, "conv_id long, formatted string, loss_runs array<int>")
    wrong = right.selectExpr("conv_id", "formatted", "array(8, 4, 25, 0) AS loss_runs")
    for df, learnt in ((right, "c\\d"), (wrong, "a<b")):
        (x,) = chat_format.read_back(df).collect()
        assert (x.n_turns, x.loss_chars) == (2, 3)
        assert x.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_fuzzy_passages(spark):
    r = random.Random(6)
    words = [f"v{i}" for i in range(3000)]
    fill = lambda k: r.choices(words, k=k)
    passage, line = fill(80), fill(12)
    edited = [w if r.random() > 0.08 else r.choice(words) for w in passage]
    del edited[40:43]
    rows = [
        (1, fill(50) + passage + fill(30)),
        (2, fill(20) + passage + fill(90)),
        (3, edited + fill(40)),
        (4, fill(120) + line),
        (5, line + fill(70)),
        (6, fill(200)),
        (8, ["again"] * 500),
        (9, ["again"] * 300 + fill(60)),
    ]
    rows = [(n, " ".join(w)) for n, w in rows]
    rows += [(7, rows[5][1]), (10, None), (11, ""), (None, rows[0][1]), (12, "one two"), (6, rows[0][1])]
    got = {(x.doc_id, x.n_words): x for x in substring.substring_dedup(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    found = lambda n: next(x for (i, _), x in got.items() if i == n)
    assert found(1).n_repeated == found(4).n_repeated == found(5).n_repeated == 0
    p = found(2).passages[0]
    assert (p.start, p.stop, p.source, p.source_start, p.source_stop, p.similarity) == (20, 100, 1, 50, 130, 1.0)
    q = found(3).passages[0]
    assert q.source == 1 and q.start <= 8 and q.stop >= 70 and 0.75 <= q.similarity < 1
    assert found(7).sources == [6] and found(7).n_repeated == 200
    assert found(8).n_repeated == found(9).n_repeated == 0  # one word over and over
    assert got[6, 160].sources == [1] and got[6, 160].n_repeated == 160
    assert substring.substring_dedup(documents(spark, [])).collect() == []


def test_passages_with_dense_edits(spark):
    passage = [f"u{i}" for i in range(60)]
    fill = lambda a, k: [f"{a}{i}" for i in range(k)]
    rows = [(1, fill("a", 20) + passage + fill("b", 20))]
    for n in (6, 8, 11):  # a word changed every n words
        edited = [f"new{n}x{i}" if i % n == n - 1 else w for i, w in enumerate(passage)]
        rows.append((n, fill(f"c{n}x", 25) + edited + fill(f"d{n}x", 25)))
    got = {x.doc_id: x for x in substring.substring_dedup(documents(spark, [(n, " ".join(w)) for n, w in rows])).collect()}
    for n in (6, 8, 11):
        (first, *_) = got[n].passages
        assert (first.start, first.source, first.source_start) == (25, 1, 20) and first.stop >= 25 + 59 - n
        assert first.similarity >= 0.75


def test_passages_of_later_holders(spark):
    r = random.Random(11)
    fresh = lambda k, n=iter(range(10**6)): [f"u{next(n)}" for _ in range(k)]
    passage, other = fresh(60), fresh(40)
    # every stretch of the passage is first held by another document, none holds it whole before 20
    rows = [(i, fresh(30) + passage[6 * i : 6 * i + 10] + fresh(30)) for i in range(10)]
    rows += [(20, fresh(50) + passage + fresh(20)), (21, fresh(35) + passage + fresh(35))]
    # hot short line inside a passage that only two documents hold
    line = fresh(12)
    rows += [(100 + i, fresh(20 + i % 7) + line + fresh(20)) for i in range(60)]
    mixed = other[:20] + line + other[20:]
    rows += [(90 + i, fresh(9) + part + fresh(9)) for i, part in enumerate((other[:14], other[10:24], other[20:34], other[30:]))]
    rows += [(200, fresh(40) + mixed + fresh(10)), (201, fresh(15) + mixed + fresh(15))]
    r.shuffle(rows)
    df = documents(spark, [(n, " ".join(w)) for n, w in rows])
    got = {x.doc_id: x for x in substring.substring_dedup(df).collect()}
    told = lambda n: {(p.start, p.stop, p.source, p.source_start, p.source_stop, p.similarity) for p in got[n].passages}
    assert told(21) == {(35, 95, 20, 50, 110, 1.0)}
    assert told(201) == {(15, 67, 200, 40, 92, 1.0)}
    assert all(not got[n].passages for n in got if n not in (21, 201))


def test_recall_against_quadratic_chaining(spark):
    r = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    lines = [r.choices(words, k=12) for _ in range(3)]
    base = [r.choices(words, k=r.randrange(30, 60)) for _ in range(12)]
    rows = []
    for n in range(90):
        rate = r.choice([0.05, 0.1, 0.15, 0.2])
        text = r.choices(words, k=20)
        for part in r.sample(base, 2):
            cut = part[r.randrange(3) :]
            text += [w if r.random() > rate else r.choice(words) for w in cut]
            text += r.choice(lines) + r.choices(words, k=r.randrange(40))
        rows.append((n, text))
    got = {x.doc_id: x for x in substring.substring_dedup(documents(spark, [(n, " ".join(w)) for n, w in rows])).collect()}
    at = {n: {} for n, _ in rows}
    for n, w in rows:
        for i in range(len(w) - 4):
            at[n].setdefault(tuple(w[i : i + 5]), []).append(i)
    for n, a in rows:
        want, have, seeds = set(), set(), set()
        for m, b in rows[:n]:
            matches = [(x, y) for k, xs in at[n].items() for x in xs for y in at[m].get(k, ())]
            if matches:
                x, y = substring.run_ends(*np.array(matches).T)
                for chain in substring.chains(list(zip(x.tolist(), y.tolist(), strict=True))):
                    if p := substring.align(a, b, chain):
                        want |= set(range(p[0], p[1]))
                        seeds |= {x + j for x, _ in matches for j in range(5) if p[0] <= x and x + 5 <= p[1]}
        for p in got[n].passages:
            have |= set(range(p.start, p.stop))
        assert have <= want and seeds <= have


def test_hot_lines_are_not_compared_pair_by_pair(spark, monkeypatch):
    r = random.Random(13)
    fresh = lambda k, n=iter(range(10**6)): [f"u{next(n)}" for _ in range(k)]
    lines = [fresh(12) for _ in range(8)]
    rows = []
    for i in range(240):
        a, b = r.sample(lines, 2)
        rows.append((i, fresh(9) + a + fresh(20) + b + fresh(9)))
    # a passage of hot lines only, of which no first holder has two
    rows += [(300 + i, fresh(9 + i) + lines[2] + lines[5] + lines[0] + fresh(9)) for i in range(2)]
    made = []

    def counted(df, name, staged=substring.staged):
        out = staged(df, name)
        made.append(out.count() if name == "pairs" else 0)
        return out

    monkeypatch.setattr(substring, "staged", counted)
    df = documents(spark, [(n, " ".join(w)) for n, w in rows])
    got = {x.doc_id: x for x in substring.substring_dedup(df).collect()}
    (p,) = got[301].passages
    assert (p.start, p.stop, p.source, p.source_start, p.source_stop, p.similarity) == (10, 46, 300, 9, 45, 1.0)
    assert all(not got[n].passages for n in got if n != 301)
    assert sum(made) < 5 * len(rows)  # a third of all pairs share a line


def test_seeds_beside_those_left_out_are_marked():
    texts = ["a b c d e f g h i", "x " * 30 + "a b c d e", "p q " * 20]
    text, key, place = substring.seeds(texts)
    same = substring.marked_seeds(texts)
    assert (text == same[0]).all() and (key == same[1]).all() and (place == same[2] >> 2).all()
    for i, t in enumerate(texts):
        kept = set(place[text == i].tolist())
        last = len(t.split()) - 5
        for x, m in zip(place[text == i].tolist(), (same[2][text == i] & 3).tolist(), strict=True):
            assert m == (x > 0 and x - 1 not in kept) + 2 * (x < last and x + 1 not in kept)
    assert (same[2] & 3).any()


def test_chains_against_all_orders():
    for seed in range(150):
        r = random.Random(seed)
        matches = sorted({(r.randrange(30), r.randrange(30)) for _ in range(r.randrange(1, 20))})
        best = []
        for i, (x, y) in enumerate(matches):
            before = [best[j] - substring.COST * (x - a + y - b) for j, (a, b) in enumerate(matches[:i]) if a < x and b < y]
            best.append(substring.GAIN + max([0, *before]))
        score = lambda c: substring.GAIN * len(c) - substring.COST * sum(q[0] - p[0] + q[1] - p[1] for p, q in zip(c, c[1:], strict=False))
        assert max(map(score, substring.chains(matches))) == pytest.approx(max(best))


def test_quality(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    good = [x for x in rows if x.quality == 1]
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in rows)
    assert sum(x.predicted for x in good) >= 0.98 * len(good)
    assert sum(x.predicted == x.quality for x in rows) >= 0.95 * len(rows)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (4, None), (None, 1), (8, 1)], "doc_id long, quality int")
    got = quality.quality_scores(documents(spark), labels).collect()
    assert len(got) == 10 and all(0 <= x.score <= 1 for x in got)
    without = quality.quality_scores(documents(spark), labels.where("false")).collect()
    assert {x.score for x in without} == {0.5}
    assert quality.quality_scores(documents(spark, []), labels).collect() == []


def test_prior_of_a_mixture():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, 8000)
    mixture = np.concatenate([rng.normal(2, 1, 5600), rng.normal(-2, 1, 2400)])
    assert abs(quality.estimate_prior(positive, mixture) - 0.7) < 0.08


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body><header>Site name</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad top">Buy this now</div>
{main}<div id="comments"><p>First reader comment which is long enough to count as a text of its own.</p></div>
<form><label>Mail</label><input></form><footer>&copy; 2020 some words of the footer</footer></body></html>"""


def test_main_text(spark):
    body = "<h1>Head &amp; line</h1><p>Some <b>bo</b>ld text.<br>Next&nbsp;line<p>Of.</p><div class='advert'>Spam spam</div><p>End  here.</p>"
    pages = [
        (1, "u1", PAGE.format(main=f"<article>{body}</article>")),
        (2, "u2", PAGE.format(main=f"<div class='content'>{body}</div>")),
        (3, None, None),
        (4, "u4", ""),
        (5, "u5", "just words, no < markup"),
        (None, "u6", PAGE.format(main=f"<main><header>Title</header>{body}")),
        (7, "u7", "<script>never closed"),
        (7, "u7", "<p>" + "word " * 50000),
        (8, "u8", "<a href='x>y' title=\"a>b\">Link</a> &lt;b&gt;"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS kind")
    got = {(x.page_id, x.n_chars > 1000): x for x in html_text.extract_pages(df.repartition(3)).collect()}
    want = "Head & line Some bold text. Next line Of. End here."
    assert got[1, False].text == got[2, False].text == want
    assert got[None, False].text.startswith("Title " + want)
    assert got[3, False].text == got[4, False].text == got[7, False].text == ""
    assert got[5, False].text == "just words, no < markup"
    assert got[7, True].n_chars == 5 * 50000 - 1
    assert got[8, False].text == "Link <b>"
    assert html_text.extract_pages(df.where("false")).collect() == []


@pytest.mark.parametrize("element", ["article", "div"])
@pytest.mark.parametrize(
    "names", ["post comments-open", "share-post", "entry has-sidebar", "related-content", "widget-article", "story"]
)
def test_names_do_not_lose_the_article(element, names):
    body = "<h1>Head line of it</h1><p>Words <math>of x</math> and <noscript>more of</noscript> them.</p><object>Last ones.</object>"
    page = PAGE.format(main=f"<{element} class='{names}'>{body}</{element}>")
    want = "Head line of it Words of x and more of them. Last ones."
    assert html_text.extract(page, {}) == want
    assert html_text.extract(page.replace("<div id", "<div class='layout has-comments'><div id"), {}) == want


def test_learnt_weights_outvote_names():
    page = "<div class='banner'>One two three four.</div><div class='strange'>Five six seven.</div>"
    assert html_text.extract(page, {}) == "Five six seven."
    assert html_text.extract(page, {"banner": 9.0, "strange": -9.0}) == "One two three four."


def test_deep_pages_take_linear_time():
    for open_, n in (("<div>", 100_000), ("<ul class='nav x'>", 100_000), ("</div>", 100_000)):
        began = time.perf_counter()
        assert html_text.extract(open_ * n + "<article>Just these words.</article>", {}) in ("Just these words.", "")
        assert html_text.labelled_counts(open_ * n + "<article>Just these words.</article>") is not None
        assert time.perf_counter() - began < 20


def test_best_region_against_all_regions():
    """Every contiguous region of random pages is tried: none has a higher score."""
    rng = random.Random(8)
    parts = ["<p>", "</p>", "<b>", "one two three", "word", "<nav>a b c d</nav>", "<div class=ad>x y</div>", "<br>", "<i></i>"]
    for _ in range(300):
        tokens = rng.choices(parts, k=12)
        texts = ["".join(tokens[i:j]) for i in range(12) for j in range(i + 1, 13)]
        score = lambda text: sum(
            html_text.LOW * len(w.split()) if low else len(w.split()) if w[0] != "<" else -html_text.TAG_COST * (2 if "nav" in w else 1)
            for w, low in pieces(text)
        )
        got = html_text.extract("".join(tokens), {})
        best = max(texts, key=score)
        words = " ".join("".join(" " if low or w[0] == "<" and w.strip("</>") not in html_text.INLINE else "" if w[0] == "<" else w for w, low in pieces(best)).split())
        if score(best) > 0 and sum(abs(score(t) - score(best)) < 1e-9 for t in texts) == 1:
            assert got == words


def pieces(text):
    """(word or tag, of little content) in order."""
    low = False
    for found in re.findall(r"<[^>]*>|[^<]+", text):
        if found.startswith(("<nav", "<div")):
            low = True
        yield found, low and found[0] != "<"
        if found.startswith(("</nav", "</div")):
            low = False


def test_runs_of_seeds_stand_for_all_their_seeds(spark):
    """Runs spread again give every seed; whoever holds one seed of a run holds all of it, in a row."""
    rng = random.Random(5)
    common = [[f"c{i}w{j}" for j in range(12)] for i in range(4)]
    rows = []
    for n in range(30):
        words = [w for _ in range(6) for w in rng.choice(common) + [f"d{n}x{rng.random()}"] * rng.randrange(3)]
        rows.append((n, n % 2, " ".join(words + ["again"] * 200 * (n % 3 == 0))))
    texts = spark.createDataFrame(rows, "doc_id long, nth int, text string")
    shared = places.shared_places(texts, substring.seeds, 3000)
    want = {(x.doc_id, x.nth, x.place): x.key for x in shared.collect()}
    runs = substring.seed_runs(shared).collect()
    got = [(x.doc_id, x.nth, x.place + i) for x in runs for i in range(x["size"])]
    assert len(got) == len(set(got)) and set(got) == set(want)
    assert len(runs) < len(want) / 3
    content = {}
    for x in runs:
        keys = tuple(want[x.doc_id, x.nth, x.place + i] for i in range(x["size"]))
        assert content.setdefault(x.key, keys) == keys and keys[0] == x.key
    inside = [k for keys in content.values() for k in keys]
    assert len(inside) == len(set(inside))  # a seed is in one run only
    for x in runs:
        holders = [k for k, v in want.items() if v == x.key]
        assert x.held == len(holders) and (x.source, x.source_nth) == min(holders)[:2]
