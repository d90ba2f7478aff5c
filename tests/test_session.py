from __future__ import annotations

from pyspark.sql import SparkSession

from rewardtables import session


def test_partitions_follow_the_input():
    large = session.settings(100 * 2**40, 4000)
    assert large["spark.sql.shuffle.partitions"] == "20000"
    assert 2**30 < int(large["spark.sql.files.maxPartitionBytes"]) < 2**31
    assert session.settings(2**40, 4, 2**37)["spark.sql.shuffle.partitions"] == str(2**10)
    assert session.settings(1000, 16)["spark.sql.shuffle.partitions"] == "16"


def test_builder_takes_the_settings():
    options = session.configure(SparkSession.builder, 5 * 2**30, 4)._options
    assert options["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert options["spark.sql.shuffle.partitions"] == "8"
    for name in session.settings(1, 1):
        SparkSession.builder._options.pop(name, None)
