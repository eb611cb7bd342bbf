"""Numbered folders that count only once they are marked as done, on any file system Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: The file that says that a folder is whole; readers of data skip names with an underscore.
DONE = "_DONE"


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    files, there = _open(spark, path)
    return files.exists(there)


def numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers n of the folders ``prefix=n``, ascending."""
    files, there = _open(spark, folder)
    if not files.exists(there):
        return []
    names = [status.getPath().getName() for status in files.listStatus(there)]
    return sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{prefix}="))


def finished(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers of the folders that are marked as done."""
    return [n for n in numbers(spark, folder, prefix) if exists(spark, f"{folder}/{prefix}={n}/{DONE}")]


def finish(spark: SparkSession, path: str) -> None:
    """Mark a folder as done, after all of it has been written."""
    files, there = _open(spark, f"{path}/{DONE}")
    files.create(there, True).close()


def drop(spark: SparkSession, path: str) -> None:
    files, there = _open(spark, path)
    files.delete(there, True)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below some folders; lists them, reads none."""
    total = 0
    for path in paths:
        files, there = _open(spark, path)
        total += files.getContentSummary(there).getLength() if files.exists(there) else 0
    return total
