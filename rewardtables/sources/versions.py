"""Small results of which readers see whole versions.

A version is written under a name of its own; then one rename replaces the file that names the current one. A reader
takes the version that is current when it looks and finds it whole; later writes leave that version
alone until ``keep`` newer ones have come. One writer at a time; the file system must replace a file by a rename at once, as
HDFS and local ones do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_CURRENT = "CURRENT"
_RUN = "run-"


def _file_system(spark: SparkSession, base: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(base)
    return hadoop, root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, base_dir: str) -> str:
    """What the file ``CURRENT`` says; empty if there is none."""
    hadoop, root, fs = _file_system(spark, base_dir)
    place = hadoop.Path(root, _CURRENT)
    if not fs.exists(place):
        return ""
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def set_manifest(spark: SparkSession, base_dir: str, text: str) -> None:
    """Replace the file ``CURRENT`` in one step."""
    hadoop, root, fs = _file_system(spark, base_dir)
    new = hadoop.Path(root, f".{_CURRENT}-{uuid.uuid4().hex}")
    out = fs.create(new, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    replace(spark, new, hadoop.Path(root, _CURRENT))


def delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        hadoop, root, fs = _file_system(spark, folder)
        fs.delete(root, True)


def current_runs(spark: SparkSession, base_dir: str) -> list[str]:
    """Names of the runs that are kept, the current one first; none if nothing was published."""
    return manifest(spark, base_dir).split()


def current(spark: SparkSession, base_dir: str) -> str | None:
    """Folder of the current version."""
    runs = current_runs(spark, base_dir)
    return f"{base_dir.rstrip('/')}/{runs[0]}" if runs else None


def replace(spark: SparkSession, source, target) -> None:
    """Rename a file (Hadoop paths) over another in one step."""
    hadoop, _, fs = _file_system(spark, target.toString())
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(source), fs.makeQualified(target), options)


def publish(spark: SparkSession, base_dir: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Let ``write`` fill a new folder, then make it the current version; its path is returned.

    Versions older than the last ``keep`` are deleted after the switch. What a failed write leaves behind
    is named by no reader.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    base = base_dir.rstrip("/")
    run = _RUN + uuid.uuid4().hex
    write(f"{base}/{run}")
    kept = [run, *current_runs(spark, base)]
    set_manifest(spark, base, "\n".join(kept[:keep]))
    delete(spark, [f"{base}/{old}" for old in kept[keep:]])
    return f"{base}/{run}"
