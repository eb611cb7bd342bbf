"""People generated at a steady pace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peopleflow.operators.messages import fanout
from peopleflow.operators.synth import people_of
from peopleflow.schemas import KEY


def id_stream(spark: SparkSession, per_batch: int = 1, last_id: int = 0) -> DataFrame:
    """Ids ``last_id + 1, last_id + 2, ...``, ``per_batch`` per trigger.

    A delay of d seconds per record is one record per batch at a d-second trigger. A restart on
    the same checkpoint goes on after the last id of a finished batch.
    """
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_batch).load()
    return rate.select((F.col("value") + last_id + 1).alias(KEY))


def message_stream(ids: DataFrame, key: str = KEY, seed: int = 42) -> DataFrame:
    """(id, topic, value): the messages of each id's person, from any stream of ids."""
    return fanout(people_of(ids, key, seed), keep=[KEY])
