"""A table that micro-batches add to, each batch once, in a bounded number of folders.

Every batch writes a folder of its own; one rename of the small file ``CURRENT`` makes it part of the table
and notes its batch id. When ``every`` folders have come they are merged into one, by a function that keeps
what readers still need. Folders that were merged stay until the next merge, so a reader that opened the table
before finds them. One writer at a time, batch ids that rise, as ``foreachBatch`` has them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rewardtables.sources import versions

EVERY = 16


def append(
    batch: DataFrame, base_dir: str, batch_id: int, merge: Callable[[DataFrame], DataFrame], every: int = EVERY
) -> bool:
    """Add the rows of a batch; False, and no change, if the table has had that batch id.

    ``merge`` gets the rows of all folders and returns those to keep, in the same columns.
    """
    spark, base = batch.sparkSession, base_dir.rstrip("/")
    state = versions.manifest(spark, base)
    state = json.loads(state) if state else {"last": -1, "folders": [], "merged": []}
    if batch_id <= state["last"]:
        return False
    folder = f"batch-{batch_id}-{uuid.uuid4().hex}"
    batch.write.parquet(f"{base}/{folder}")
    folders, gone = [*state["folders"], folder], []
    merged = state["merged"]
    if len(folders) >= every:
        whole = f"merged-{batch_id}-{uuid.uuid4().hex}"
        rows = spark.read.schema(batch.schema).parquet(*[f"{base}/{f}" for f in folders])
        merge(rows).coalesce(1).write.parquet(f"{base}/{whole}")
        gone, merged, folders = merged, folders, [whole]
    versions.set_manifest(spark, base, json.dumps({"last": batch_id, "folders": folders, "merged": merged}))
    versions.delete(spark, [f"{base}/{f}" for f in gone])
    return True


def read(spark: SparkSession, base_dir: str, schema: str | T.StructType) -> DataFrame:
    """The rows of all folders of the table as it is now; none before the first batch."""
    base = base_dir.rstrip("/")
    state = versions.manifest(spark, base)
    if not state:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base}/{f}" for f in json.loads(state)["folders"]])
