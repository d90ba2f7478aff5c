"""Stream and batch give the same rows."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from rewardtables.plans import fixtures
from rewardtables.sources import deltas
from rewardtables.streaming import periodic


@pytest.fixture(scope="module")
def parts(spark, sf_dir, tmp_path_factory):
    """The events in time order as several files, one per trigger."""
    base = tmp_path_factory.mktemp("events")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = events.count()
    for i in range(5):
        chunk = events.where((F.col("event_id") >= n * i // 5) & (F.col("event_id") < n * (i + 1) // 5))
        chunk.coalesce(1).write.mode("append").parquet(f"{base}/in")
    return f"{base}/in", events.schema


def stream(spark, parts):
    path, schema = parts
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    return fixtures.rollouts_from_events(source)


def test_rewards_run_on_a_stream(spark, parts, sf_dir, tmp_path):
    out = str(tmp_path / "out")
    query = (
        periodic.score(stream(spark, parts)).drop("ts").writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out)
    )
    query.awaitTermination(120)
    batch = periodic.score(fixtures.rollouts(spark, sf_dir)).drop("ts")
    streamed = spark.read.schema(batch.schema).parquet(out)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_windows_match_the_batch(spark, parts, sf_dir, tmp_path):
    windows = periodic.periodic_eval_stream(stream(spark, parts), "ts", "1 day", "40 days", fraction=0.5)
    query = (
        windows.writeStream.outputMode("complete").format("memory").queryName("windows")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = {r["window_start"]: r for r in spark.table("windows").collect()}
    batch = periodic.periodic_eval_stream(fixtures.rollouts(spark, sf_dir), "ts", "1 day", "40 days", fraction=0.5)
    expected = {r["window_start"]: r for r in batch.collect()}
    assert set(got) == set(expected) and len(got) >= 20
    for start, row in expected.items():
        for name, value in row.asDict().items():
            assert got[start][name] == (pytest.approx(value) if isinstance(value, float) else value)


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_path):
    base = str(tmp_path / "in")
    schema = "event_id BIGINT, ts TIMESTAMP, completion STRING, answer STRING"
    day = datetime.datetime(2024, 1, 1)
    # Spark drops late rows by the watermark of two triggers ago
    batches = [
        [(1, day, "1", "1"), (2, day + datetime.timedelta(hours=1), "x", "1")],
        [(3, day + datetime.timedelta(days=5), "1", "1")],
        [(7, day + datetime.timedelta(days=6), "1", "1")],
        [(4, day, "1", "1"), (5, day + datetime.timedelta(days=9), "1", "1")],
        [(6, day + datetime.timedelta(days=9), "1", "1")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(base)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(base)
    query = (
        periodic.periodic_eval_stream(source, "ts", "1 day", "1 hour").writeStream.outputMode("append")
        .format("memory").queryName("late").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = {r["window_start"]: (r["n"], r["accuracy"]) for r in spark.table("late").collect()}
    assert got[day] == (2, 0.5)
    assert got[day + datetime.timedelta(days=5)] == (1, 1.0)


def test_exact_sample_over_micro_batches(spark, parts, sf_dir, tmp_path):
    path = str(tmp_path / "candidates")
    write = periodic.sample_writer(path, "event_id", "event_id", every=3000, samples=32, merge_every=3)
    source = stream(spark, parts)
    query = (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    kept = lambda: deltas.read(spark, path, source.schema)
    rows = kept().count()
    write(kept().limit(5), 0)  # a batch that runs again
    assert kept().count() == rows
    got = periodic.sampled_eval(spark, path, source.schema, "event_id", "event_id", every=3000, samples=32)
    expected = periodic.periodic_eval(fixtures.rollouts(spark, sf_dir), "event_id", every=3000, samples=32)
    a, b = ({r["eval_step"]: tuple(r) for r in df.collect()} for df in (got, expected))
    assert set(a) == set(b) and len(a) > 1
    for step, row in b.items():
        assert a[step] == pytest.approx(row)


def test_stored_candidates_are_bounded_by_the_buckets(spark, tmp_path):
    path = str(tmp_path / "candidates")
    write = periodic.sample_writer(path, "step", "id", every=100, samples=8, merge_every=4)
    df = spark.range(3000).select("id", (F.col("id") % 200).alias("step"))
    counts, folders, opened = [], [], None
    for batch in range(20):
        write(df.where(F.col("id") % 20 == batch), batch)
        counts.append(deltas.read(spark, path, df.schema).count())
        folders.append(len([x for x in os.listdir(path) if x.startswith(("batch-", "merged-"))]))
        if batch == 6:
            opened = deltas.read(spark, path, df.schema)
        if batch == 7:  # merged since: the old folders are there until the next merge
            assert opened.count() == counts[6]
    # two buckets: at most 8 rows each in the merged folder and in every batch since
    assert max(counts) <= 4 * 2 * 8 and max(folders) <= 8
    got = periodic.sample_per_bucket(deltas.read(spark, path, df.schema), "step", "id", samples=8)
    want = periodic.sample_per_bucket(df, "step", "id", samples=8)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_written_windows_are_complete(spark, parts, sf_dir, tmp_path):
    windows = periodic.periodic_eval_stream(stream(spark, parts), "ts", "1 day", "40 days")
    out = str(tmp_path / "out")
    periodic.start_windows(windows, out, str(tmp_path / "cp"), availableNow=True).awaitTermination(120)
    got = {r["window_start"]: tuple(r) for r in periodic.read_windows(spark, out, windows.schema).collect()}
    batch = periodic.periodic_eval_stream(fixtures.rollouts(spark, sf_dir), "ts", "1 day", "40 days")
    expected = {r["window_start"]: tuple(r) for r in batch.collect()}
    assert set(got) == set(expected)
    for start, row in expected.items():
        assert got[start][0] == row[0] and got[start][1:] == pytest.approx(row[1:])


def test_stream_reads_a_folder_of_parts(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    rows = fixtures.rollout_stream(spark, str(tmp_path)).writeStream.format("memory").queryName("parts")
    rows.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.table("parts").count() == fixtures.rollouts(spark, sf_dir).count()


def test_sample_size(spark):
    df = spark.range(250).withColumn("step", F.col("id") - 50)
    got = {r["eval_step"]: r["count"] for r in periodic.sample_per_bucket(df, "step", "id").groupBy("eval_step").count().collect()}
    assert got == {-100: 32, 0: 32, 100: 32}
    small = periodic.sample_per_bucket(df, "step", "id", every=10, samples=32).count()
    assert small == 250
    large = periodic.sample_per_bucket(spark.range(20000), "id", "id", every=10000, samples=1500)
    counts = {r["eval_step"]: r["count"] for r in large.groupBy("eval_step").count().collect()}
    assert counts == {0: 1500, 10000: 1500}
