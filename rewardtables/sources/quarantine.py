"""JSON logs with broken lines: good ones go on, broken ones are kept with file and reason."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rewardtables.sources.scratch import scratch_dir

REASONS = ("blank", "not JSON", "not an object", "wrong type")


class Log(NamedTuple):
    """``good``: line, parsed. ``broken``: line, file, reason. ``counts``: lines, good, broken."""

    good: DataFrame
    broken: DataFrame
    counts: dict[str, int]


def _reason(line: Column, bad: Column) -> Column:
    """Why a line is broken, NULL for a good one; only lines that do not fit are looked at again."""
    whole = F.try_parse_json(_wrapped(line))
    one = (F.try_variant_get(whole, "$.end", "int") == 1) & F.try_variant_get(whole, "$.row[1]", "variant").isNull()
    kind = F.schema_of_variant(F.try_variant_get(whole, "$.row[0]", "variant"))
    return F.when(
        bad,
        F.when(F.trim(line) == "", REASONS[0])
        .when(~F.coalesce(one, F.lit(False)), REASONS[1])
        .when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), REASONS[2])
        .otherwise(REASONS[3]),
    )


def _wrapped(line: Column) -> Column:
    """The line as the one element of an array: parsers stop at a value's end and would pass over what follows it."""
    return F.concat(F.lit('{"row":['), line, F.lit('],"end":1}'))


def read_log(spark: SparkSession, path: str, schema: str, table: str | None = None) -> Log:
    """Read a log of one JSON object per line, apart good and broken lines.

    ``schema`` lists the object's fields; fields that a line lacks are NULL, others are ignored. A line is broken
    where it is blank, no JSON (or more than one object), no object, or where a field does not fit its type. Every line is
    parsed once and written to ``table`` (a new folder), good and broken ones in folders of their own.
    Lines read and lines written are counted, and must agree. An empty log gives two empty tables.
    """
    table = table or scratch_dir(spark, "log")
    seen = Observation("log")
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    wrapper = f"row ARRAY<STRUCT<{schema}>>, end INT, corrupt STRING"
    found = lines.observe(seen, F.count(F.lit(1)).alias("n"))
    # a column of its own, so that each line is parsed once
    found = found.withColumn("whole", F.from_json(_wrapped(F.col("line")), wrapper, options))
    row = F.get("whole.row", F.lit(0))
    fits = (F.col("whole.end") == 1) & F.col("whole.corrupt").isNull() & (F.size("whole.row") == 1) & row.isNotNull()
    found = found.withColumn("reason", _reason(F.col("line"), ~F.coalesce(fits, F.lit(False))))
    parsed = F.when(F.col("reason").isNull(), row).alias("parsed")
    found = found.select("line", "file", parsed, "reason", F.col("reason").isNotNull().alias("broken"))
    found.write.partitionBy("broken").parquet(table)
    stored = spark.read.schema(found.schema).parquet(table)
    counts = {r["broken"]: r["count"] for r in stored.groupBy("broken").count().collect()}
    counts = {"lines": seen.get["n"], "good": counts.get(False, 0), "broken": counts.get(True, 0)}
    if counts["lines"] != counts["good"] + counts["broken"]:
        raise RuntimeError(f"lines were lost on the way to {table}: {counts}")
    good = stored.where("NOT broken").select("line", "parsed")
    return Log(good, stored.where("broken").select("line", "file", "reason"), counts)
