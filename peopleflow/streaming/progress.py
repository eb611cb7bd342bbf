"""How a stream is doing, as a table that grows with it."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from peopleflow import versions
from peopleflow.functions.json_text import is_message
from peopleflow.schemas import TOPIC_FIELDS

OBSERVED = "messages"

SCHEMA = "batch_id bigint, input_rows bigint, rows_per_second double, " + ", ".join(
    f"{name} bigint" for name in (*TOPIC_FIELDS, "malformed")
)


def observed(log: DataFrame) -> DataFrame:
    """Let a stream count its messages by topic, and those that are none, while it reads them."""
    topics = [F.count_if(F.col("topic") == topic).alias(topic) for topic in TOPIC_FIELDS]
    return log.observe(OBSERVED, *topics, F.count_if(~is_message("value")).alias("malformed"))


class ProgressTable(StreamingQueryListener):
    """Writes a row for every micro-batch that read something to ``path/batch_id=<n>`` and keeps none.

    A repeated micro-batch overwrites its own row, and a stream that goes on from its checkpoint
    adds to the table. One stream to a table.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._ended = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        seen = p.observedMetrics.get(OBSERVED)
        counts = [seen[name] if seen is not None else None for name in (*TOPIC_FIELDS, "malformed")]
        row = (p.batchId, p.numInputRows, float(p.processedRowsPerSecond or 0.0), *counts)
        made = self.spark.createDataFrame([row], SCHEMA).coalesce(1)
        made.write.mode("overwrite").parquet(f"{self.path}/batch_id={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until all of an ended run is in the table, which events tell a little later."""
        run = str(query.runId)
        if not self._ended[run].wait(seconds):
            raise TimeoutError(f"the end of run {run} was not reported within {seconds} s")


@contextmanager
def progress_table(spark: SparkSession, path: str) -> Iterator[ProgressTable]:
    """Note the progress of a stream that is started inside the block."""
    table = ProgressTable(spark, path)
    spark.streams.addListener(table)
    try:
        yield table
    finally:
        spark.streams.removeListener(table)


def progress_report(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, input_rows, a column per topic, malformed) of every micro-batch that read something."""
    return _written(spark, path).drop("rows_per_second")


def rates(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, rows_per_second): how fast each micro-batch was, as Spark measured it."""
    return _written(spark, path).select("batch_id", "rows_per_second")


def _written(spark: SparkSession, path: str) -> DataFrame:
    if not versions.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path).select(*empty.columns)
