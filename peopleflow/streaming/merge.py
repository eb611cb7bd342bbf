"""The topic merge, kept up to date as messages arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from peopleflow.operators.merge import merge_messages
from peopleflow.schemas import KEY, PEOPLE_SCHEMA
from peopleflow.session import child_session
from peopleflow.streaming.expiry import merge_expiring
from peopleflow.streaming.sinks import LARGE_STATE, last_rows, start_versions


def start_merge(
    log: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    expire_after: str | None = None,
) -> StreamingQuery:
    """Merge a streamed topic log; every change of a complete record is written to ``path``.

    The checkpoint holds the read positions and the partial records, so a restart goes on where
    the last run stopped. With ``every=None`` the run drains the topics and ends. A log read in a
    session of `merge_session` keeps the state, a row for each id, off the heap. With
    ``expire_after`` ids that stay incomplete so long are forgotten; a checkpoint keeps to one way.
    """
    merged = merge_expiring(log, expire_after) if expire_after else merge_messages(log)
    return start_versions(merged, path, checkpoint, "update", every, KEY)


def merge_session(spark: SparkSession) -> SparkSession:
    """A session for merges of many ids, apart from ``spark``."""
    return child_session(spark, LARGE_STATE)


def merged_records(spark: SparkSession, path: str) -> DataFrame:
    """The complete records as of the last micro-batch."""
    return last_rows(spark, path, PEOPLE_SCHEMA, KEY)
