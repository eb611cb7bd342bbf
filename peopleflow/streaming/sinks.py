"""Where streaming results go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from peopleflow import versions
from peopleflow.session import ROCKSDB

# For state with a row per id: kept in RocksDB, off the JVM heap, uploading changes only. Its rows are
# not counted, which would look up every id once more before it is written. A task reads no more of a
# log than it can sort in memory, however much a micro-batch admits.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.files.maxPartitionBytes": "16m",
}

# Changes after which a snapshot is made: so many if they weigh as much as the last one, so many in any case.
COMPACT_AFTER, COMPACT_ALWAYS = 8, 64


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run at an interval, or with None drain what is there and stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_console(result: DataFrame, every: str | None = "15 seconds") -> StreamingQuery:
    """Print the whole, small result of a live report again and again."""
    writer = result.writeStream.outputMode("complete").format("console").option("truncate", False)
    return triggered(writer, every).start()


def start_versions(
    result: DataFrame,
    path: str,
    checkpoint: str,
    mode: str,
    every: str | None = None,
    key: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch of an aggregation to ``path/changes/batch_id=<n>``.

    A repeated micro-batch overwrites its own folder, so a restart leaves no duplicates. In complete
    mode a micro-batch is the whole result, and only the last two are kept. In update mode, with the ``key`` of the
    rows, changes are brought together into snapshots from time to time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        spark = batch.sparkSession
        if mode == "complete":
            for old in versions.numbers(spark, f"{path}/changes", "batch_id"):
                if old < batch_id - 1:
                    versions.drop(spark, f"{path}/changes/batch_id={old}")
        elif key:
            compact(spark, path, batch.schema, key, batch_id)

    writer = (
        result.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return triggered(writer, every).start()


def compact(spark: SparkSession, path: str, schema: StructType, key: str, batch_id: int) -> bool:
    """Bring the changes since the last snapshot and that snapshot together into a new one, if it is time.

    It is when there are COMPACT_AFTER changes or more that weigh as much as the snapshot, or
    COMPACT_ALWAYS, so a reader's bytes stay below twice the records, and so, on the whole, do the bytes
    written. A snapshot counts once it is marked; only then goes what the one before it
    replaced, so a reader that has just listed the folders still finds them.
    """
    last, changes = _newest(spark, path)
    changes = [n for n in changes if n <= batch_id]
    snapshots = f"{path}/snapshots"
    if len(changes) < COMPACT_AFTER:
        return False
    grown = versions.stored_bytes(spark, *[f"{path}/changes/batch_id={n}" for n in changes])
    if len(changes) < COMPACT_ALWAYS and last is not None:
        if grown < versions.stored_bytes(spark, f"{snapshots}/upto={last}"):
            return False
    last_rows(spark, path, schema, key).write.mode("overwrite").parquet(f"{snapshots}/upto={batch_id}")
    versions.finish(spark, f"{snapshots}/upto={batch_id}")
    for n in versions.numbers(spark, snapshots, "upto"):
        if last is not None and n < last:
            versions.drop(spark, f"{snapshots}/upto={n}")
    for n in versions.numbers(spark, f"{path}/changes", "batch_id"):
        if last is not None and n <= last:
            versions.drop(spark, f"{path}/changes/batch_id={n}")
    return True


def start_append(
    result: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append rows to a Parquet folder, each exactly once."""
    writer = (
        result.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return triggered(writer, every).start()


def _newest(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """The number of the newest snapshot, and of the changes after it."""
    last = max(versions.finished(spark, f"{path}/snapshots", "upto"), default=None)
    changes = versions.numbers(spark, f"{path}/changes", "batch_id")
    return last, [n for n in changes if last is None or n > last]


def last_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The result as the last micro-batch of a complete-mode stream left it; no other is read."""
    written = versions.numbers(spark, f"{path}/changes", "batch_id")
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/changes/batch_id={written[-1]}")


def last_rows(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """The newest version of every id in an update-mode stream: the newest snapshot and the changes since."""
    last, changes = _newest(spark, path)
    rest = [name for name in schema.names if name != key]
    found = spark.createDataFrame([], StructType([*schema.fields, StructField("batch_id", LongType())]))
    if last is not None:
        snapshot = spark.read.schema(schema).parquet(f"{path}/snapshots/upto={last}")
        if not changes:
            return snapshot
        found = snapshot.withColumn("batch_id", F.lit(last).cast("long"))
    if changes:
        # The folders' names give the number of the change.
        paths = [f"{path}/changes/batch_id={n}" for n in changes]
        reader = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())]))
        rows = reader.option("basePath", f"{path}/changes").parquet(*paths)
        found = rows if last is None else found.unionByName(rows)
    newest = F.max(F.struct("batch_id", F.struct(*rest).alias("row")))
    return found.groupBy(key).agg(newest.alias("last")).select(key, "last.row.*")
