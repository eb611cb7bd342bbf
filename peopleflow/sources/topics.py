"""Topic logs: from a Kafka broker, or replayed from files with the same columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from peopleflow.schemas import LOG_SCHEMA
from peopleflow.sources.snapshot import pinned_options


def topic_options(
    brokers: str,
    topics: Sequence[str],
    starting: str = "earliest",
    ending: str | None = None,
    max_per_trigger: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source. ``ending`` is for batch reads only.

    Further options go through as they are; write ``kafka__security__protocol`` for dotted names.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if ending is not None:
        options["endingOffsets"] = ending
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options | {name.replace("__", "."): value for name, value in extra.items()}


def _log_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("value", df["value"].cast("string")).select(*LOG_SCHEMA.names)


def read_topics(
    spark: SparkSession, brokers: str, topics: Sequence[str], **extra: str
) -> DataFrame:
    """All messages now on the topics. Commits nothing, so other readers are not disturbed."""
    options = topic_options(brokers, topics, "earliest", "latest", **extra)
    return _log_columns(spark.read.format("kafka").options(**options).load())


def read_topics_until(spark: SparkSession, brokers: str, ends: DataFrame, **extra: str) -> DataFrame:
    """The messages up to the ends that `snapshot.log_ends` found, however much has arrived since."""
    options = topic_options(brokers, [], "earliest", **extra) | pinned_options(ends)
    del options["subscribe"]
    return _log_columns(spark.read.format("kafka").options(**options).load())


def stream_topics(
    spark: SparkSession,
    brokers: str,
    topics: Sequence[str],
    starting: str = "latest",
    max_per_trigger: int | None = None,
    **extra: str,
) -> DataFrame:
    """Messages as they arrive. ``starting`` counts for the first run of a checkpoint only."""
    options = topic_options(brokers, topics, starting, max_per_trigger=max_per_trigger, **extra)
    return _log_columns(spark.readStream.format("kafka").options(**options).load())


def write_replay(
    log: DataFrame,
    path: str,
    files: int | None = None,
    by_topic: bool = False,
    rows_per_file: int | None = None,
) -> None:
    """Store a topic log for replay, as it is partitioned.

    ``rows_per_file`` bounds the files, so that `stream_replay` can admit a share of them to a
    micro-batch; ``files`` asks for that many files instead, which moves all rows. ``by_topic``
    makes a folder per topic, so that reading one topic skips the others.
    """
    writer = (log.repartition(files) if files else log).write.mode("append")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy("topic") if by_topic else writer).parquet(path)


def read_replay(spark: SparkSession, path: str) -> DataFrame:
    """A stored topic log as one table."""
    return spark.read.parquet(path).select(*LOG_SCHEMA.names)


def stream_replay(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    glob: str | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A stored topic log, or any Parquet folder, as a stream; a micro-batch admits files or bytes."""
    stored = spark.read.option("pathGlobFilter", glob or "*.parquet").parquet(path)
    reader = spark.readStream.schema(stored.schema).option("pathGlobFilter", glob or "*.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)
