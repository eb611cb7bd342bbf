"""The first N complete ids, over any number of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peopleflow import versions
from peopleflow.operators.completion import done_position, first_states, nth_completion
from peopleflow.operators.merge import (
    field_messages,
    latest_of,
    latest_states,
    schema_fields,
    sent_together,
    typed,
)
from peopleflow.schemas import KEY, PEOPLE_SCHEMA, POSITION
from peopleflow.session import stage
from peopleflow.sources.snapshot import log_ends, up_to


def _new_messages(log: DataFrame, folder: str | None) -> DataFrame:
    """Messages that no run has used: those behind the ends it saw, and those behind its cut."""
    if folder is None:
        return log
    spark = log.sparkSession
    ends = spark.read.parquet(f"{folder}/ends").select("topic", "partition", F.col("last").alias("_seen"))
    cut = spark.read.parquet(f"{folder}/cut")
    unseen = F.col("_seen").isNull() | (F.col("offset") > F.col("_seen"))
    if not cut.isEmpty():
        unseen |= F.struct(*POSITION) > cut.select(F.struct(*POSITION)).scalar()
    return log.join(ends, ["topic", "partition"], "left").where(unseen).select(*log.columns)


def resume_target(
    log: DataFrame, checkpoint: str, n: int, schema: StructType = PEOPLE_SCHEMA, key: str = KEY
) -> DataFrame:
    """The first ``n`` ids of a JSON topic log to become complete, going on where the last run stopped.

    ``checkpoint`` keeps, for every id, when each field was first sent and its last value, how far
    the log had grown, and the position of the cut, the n-th completion of all runs together. A run
    reads what came after that and stops at its own cut, so a larger ``n`` goes on from the smaller
    one, and one not yet reached is reached when the log has grown. Values are as of the cut; what a former run has used stays
    used. A run's folder counts once it is marked; one that broke off is written anew.
    """
    spark = log.sparkSession
    done = versions.finished(spark, checkpoint, "run")
    before = f"{checkpoint}/run={done[-1]}" if done else None
    number = done[-1] + 1 if done else 0
    folder = f"{checkpoint}/run={number}"
    ends = stage(log_ends(log), "ends")
    messages = field_messages(_new_messages(up_to(log, ends), before), schema, key)
    fields, together = schema_fields(schema, key), sent_together(schema, key)
    firsts, lasts = first_states(fields, POSITION, together), latest_states(fields, POSITION, together)

    def merged(new: DataFrame, columns: list[str], how: dict) -> DataFrame:
        if before is None:
            return new
        old = spark.read.parquet(f"{before}/state").select(key, *columns)
        return old.unionByName(new).groupBy(key).agg(*[how[c](c).alias(c) for c in columns])

    began = messages.groupBy(key).agg(*firsts)
    first_names = [c for c in began.columns if c != key]
    how = dict.fromkeys(first_names, F.min)
    known = merged(began, first_names, how).select(key, done_position(fields, together).alias("done"))
    known = known.where(F.col("done").isNotNull()).select(key, "done.*")
    nth_completion(known, n).write.mode("overwrite").parquet(f"{folder}/cut")
    cut = spark.read.parquet(f"{folder}/cut")
    reached = not cut.isEmpty()
    if reached:
        messages = messages.where(F.struct(*POSITION) <= cut.select(F.struct(*POSITION)).scalar())
    new = messages.groupBy(key).agg(*firsts, *lasts)
    names = [c for c in new.columns if c != key]
    how |= {c: F.max for c in names if c not in how}
    merged(new, names, how).write.mode("overwrite").parquet(f"{folder}/state")
    ends.write.mode("overwrite").parquet(f"{folder}/ends")
    versions.finish(spark, folder)
    for old in done[:-1]:
        versions.drop(spark, f"{checkpoint}/run={old}")

    state = spark.read.parquet(f"{folder}/state")
    position = done_position(fields, together)
    complete = state.where(position.isNotNull())
    if reached:
        complete = complete.where(position <= cut.select(F.struct(*POSITION)).scalar())
    latest = complete.select(key, *[latest_of(f, fields, POSITION, together).alias(f) for f in fields])
    return typed(latest.select(key, *[F.col(f)["_value"].alias(f) for f in fields]), schema)
