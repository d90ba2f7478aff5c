"""Source order of files without keys, against the files themselves."""

from __future__ import annotations

import pytest

from rewardtables.sources import positions


@pytest.fixture()
def split_small(spark):
    """Files are read in many blocks, several to a task."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "1")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def write(folder, files):
    folder.mkdir()
    for name, lines in files.items():
        (folder / name).write_text("".join(f"{x}\n" for x in lines))
    return str(folder)


FILES = {
    "part-2.txt": [f"b{i}" for i in range(900)],
    "part-1.txt": ["same"] * 300 + ["", "ü" * 3000, ""],
    "part-3.txt": [],
    "part-4.txt": [f"d{i}" for i in range(7)],
}
ORDER = [x for name in sorted(FILES) for x in FILES[name]]


def test_numbered_in_file_order(spark, tmp_path, split_small):
    df = spark.read.text(write(tmp_path / "a", FILES))
    assert df.rdd.getNumPartitions() > 3
    got = sorted((r["position"], r["value"]) for r in positions.numbered(df).collect())
    assert got == list(enumerate(ORDER))


@pytest.mark.parametrize("n", [0, 1, 305, 5000])
def test_first_rows(spark, tmp_path, split_small, n):
    df = spark.read.text(write(tmp_path / "a", FILES))
    assert [r["value"] for r in positions.first_rows(df, n).collect()] == ORDER[:n]


def test_first_rows_are_a_top_k(spark, tmp_path):
    df = spark.read.text(write(tmp_path / "a", FILES))
    plan = positions.first_rows(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_shorter_side_ends_the_pairs(spark, tmp_path, split_small):
    left = spark.read.text(write(tmp_path / "a", FILES)).withColumnRenamed("value", "x")
    other = {"p-1.txt": [str(i) for i in range(100)], "p-2.txt": [str(i) for i in range(100, 600)]}
    right = spark.read.text(write(tmp_path / "b", other)).withColumnRenamed("value", "y")
    got = sorted((r["position"], r["x"], r["y"]) for r in positions.pair_rows(left, right).collect())
    assert got == [(i, x, str(i)) for i, x in enumerate(ORDER[:600])]


def test_empty_log_pairs_with_nothing(spark, tmp_path):
    left = spark.read.text(write(tmp_path / "a", FILES)).withColumnRenamed("value", "x")
    right = spark.read.text(write(tmp_path / "b", {"p.txt": []})).withColumnRenamed("value", "y")
    assert positions.pair_rows(left, right).collect() == []
    with pytest.raises(ValueError):
        positions.pair_rows(left, left)
