"""The end of a topic log at one moment, for several passes over a log that grows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peopleflow.session import stage


def log_ends(log: DataFrame) -> DataFrame:
    """(topic, partition, last, messages): the last offset of every partition that has messages.

    One aggregation over the offsets; the messages themselves are not read where files are columnar.
    """
    return log.groupBy("topic", "partition").agg(
        F.max("offset").alias("last"), F.count("*").alias("messages")
    )


def up_to(log: DataFrame, ends: DataFrame) -> DataFrame:
    """The messages that were on the log when its ends were found.

    ``ends`` has a row for each partition, so Spark broadcasts it by its size on disk.
    """
    last = ends.select("topic", "partition", F.col("last").alias("_last"))
    return log.join(last, ["topic", "partition"]).where("offset <= _last").select(*log.columns)


def pinned(log: DataFrame) -> DataFrame:
    """The log as it stands now: its ends are found once, staged, and hold for every later pass."""
    return up_to(log, stage(log_ends(log), "ends"))


def pinned_options(ends: DataFrame) -> dict[str, str]:
    """Options with which the Kafka source itself reads no further than the ends.

    The partitions are assigned by name, since ending offsets must be given for all that are read;
    partitions without messages are left out. There is a row for each partition.
    """
    named: dict[str, dict[str, int]] = {}
    for row in ends.collect():
        named.setdefault(row["topic"], {})[str(row["partition"])] = row["last"] + 1
    partitions = {topic: sorted(map(int, ends)) for topic, ends in named.items()}
    return {"assign": json.dumps(partitions, sort_keys=True), "endingOffsets": json.dumps(named, sort_keys=True)}
