"""Logs with broken lines: none is lost, each broken one has its reason."""

from __future__ import annotations

from rewardtables.sources import quarantine

SCHEMA = "ids ARRAY<INT>, name STRING"


def read(spark, folder, files):
    folder.mkdir()
    for name, lines in files.items():
        (folder / name).write_text("".join(f"{x}\n" for x in lines))
    return quarantine.read_log(spark, str(folder), SCHEMA)


def test_reasons_files_and_counts(spark, tmp_path):
    lines = {
        '{"ids":[1,2],"name":"a"}': None,
        '{"other":1}': None,
        "{}": None,
        '{"ids":null}': None,
        " ": "blank",
        "": "blank",
        '{"ids":[1': "not JSON",
        "timed out": "not JSON",
        '{"ids":[1]': "not JSON",
        '{"ids":[1]}}': "not JSON",
        '{"ids":[1]}]}': "not JSON",
        '{"ids":[1]} tail': "not JSON",
        '{"ids":[1]}{"ids":[2]}': "not JSON",
        '{"ids":[1]},{"ids":[2]}': "not JSON",
        '{"ids":[1]},"end":1': "not JSON",
        "[1,2]": "not an object",
        "17": "not an object",
        '"text"': "not an object",
        "null": "not an object",
        '{"ids":"lost"}': "wrong type",
        '{"ids":[1.5]}': "wrong type",
        '{"name":"a","ids":{}}': "wrong type",
    }
    log = read(spark, tmp_path / "log", {"a.json": lines, "b.json": ["oops", '{"name":"' + "x" * 100_000 + '"}']})
    got = {r["line"]: r["reason"] for r in log.broken.collect()}
    assert got == {k: v for k, v in lines.items() if v} | {"oops": "not JSON"}
    files = {r["line"]: r["file"].rsplit("/", 1)[1] for r in log.broken.collect()}
    assert files["oops"] == "b.json" and files["timed out"] == "a.json"
    good = {r["line"]: r["parsed"] for r in log.good.collect()}
    assert good['{"ids":[1,2],"name":"a"}'].asDict() == {"ids": [1, 2], "name": "a"}
    assert good["{}"].asDict() == {"ids": None, "name": None}
    assert log.counts == {"lines": 24, "good": 5, "broken": 19}


def test_repeated_lines_stay(spark, tmp_path):
    log = read(spark, tmp_path / "log", {"a.json": ["{}", "{}", "x", "x", "x"]})
    assert log.counts == {"lines": 5, "good": 2, "broken": 3}
    assert log.broken.count() == 3


def test_logs_without_lines_or_without_broken_ones(spark, tmp_path):
    empty = read(spark, tmp_path / "none", {"a.json": []})
    assert empty.counts == {"lines": 0, "good": 0, "broken": 0}
    assert empty.good.collect() == empty.broken.collect() == []
    clean = read(spark, tmp_path / "clean", {"a.json": ["{}"]})
    assert clean.broken.collect() == [] and clean.good.count() == 1
