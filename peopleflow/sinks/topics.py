"""Messages to Kafka topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_topics(messages: DataFrame, brokers: str) -> None:
    """Send a finite set of (topic, value) messages, without keys."""
    (
        messages.select("topic", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .save()
    )


def start_topics(
    messages: DataFrame, brokers: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Send (topic, value) messages as a stream produces them."""
    writer = (
        messages.select("topic", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(processingTime=every) if every else writer).start()
