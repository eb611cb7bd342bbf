"""The topic merge with a bound on how long incomplete ids are waited for."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StringType, StructField, StructType

from peopleflow.operators.merge import field_messages, typed
from peopleflow.schemas import KEY, PEOPLE_SCHEMA, POSITION


def merge_expiring(log: DataFrame, after: str, schema: StructType = PEOPLE_SCHEMA, key: str = KEY) -> DataFrame:
    """`merge.merge_messages` of a stream, in which an id that stays incomplete is forgotten.

    The watermark follows ``after`` behind the largest message timestamp. An incomplete id whose last
    message lies ``after`` behind the watermark loses its state, and starts anew if it is sent again;
    a complete one is kept for good. Messages older than the watermark are left out, as they always
    are where state can expire. Built-in aggregations cannot drop the state of some groups only, so
    this is a stateful operator in pandas; without expiry use the plain merge.
    """
    names = [name for name in schema.names if name != key]
    wait = int(pd.Timedelta(after).total_seconds() * 1000)
    timed = log.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", after)
    messages = field_messages(timed, schema, key)

    def merge(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = json.loads(state.get[0]) if state.exists else {}
        last = 0
        for frame in frames:
            for row in frame.to_dict("records"):
                at = [row["timestamp"].value // 1000, *(row[p] for p in POSITION[1:])]
                nulls = row["keys"] if row["keys"] is not None else ()
                last = max(last, at[0] // 1000)
                for name in names:
                    text = row[f"text_{name}"]
                    if (text is not None or name in nulls) and (name not in held or at > held[name][0]):
                        held[name] = [at, text]
        state.update((json.dumps(held),))
        if len(held) == len(names):
            yield pd.DataFrame([{key: group[0]} | {name: held[name][1] for name in names}])
        else:
            state.setTimeoutTimestamp(max(last + wait, state.getCurrentWatermarkMs() + 1))

    out = StructType([schema[key], *[StructField(name, StringType()) for name in names]])
    kept = StructType([StructField("held", StringType())])
    merged = messages.groupBy(key).applyInPandasWithState(
        merge, out, kept, "update", GroupStateTimeout.EventTimeTimeout
    )
    return typed(merged.select(*schema.names), schema)
