"""Messages of several topics to one record per id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peopleflow.functions.json_text import END, field_texts, is_present, null_keys, whole_number
from peopleflow.schemas import (
    KEY,
    PEOPLE_SCHEMA,
    POSITION,
    TOPIC_FIELDS,
)


@dataclass(frozen=True)
class Field:
    """What a message says about one field: its value, and whether it speaks of it at all."""

    value: Column
    present: Column


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions)


def shapes(fields: Mapping[str, Field], together: Sequence[Sequence[str]]) -> dict[str, tuple[list[str], Column]]:
    """Groups of fields that a message may carry as a whole: name, fields, and whether it does.

    A field may be in one group only; groups of a single field say nothing.
    """
    groups = [[name for name in group if name in fields] for group in together]
    return {
        f"_together_{k}": (group, _all([fields[name].present for name in group]))
        for k, group in enumerate(groups)
        if len(group) > 1
    }


def alone(name: str, fields: Mapping[str, Field], groups: Mapping[str, tuple[list[str], Column]]) -> Column:
    """Whether a message carries a field without all others of its group."""
    whole = [~complete for names, complete in groups.values() if name in names]
    return _all([fields[name].present, *whole])


def latest_states(
    fields: Mapping[str, Field], position: Sequence[str], together: Sequence[Sequence[str]]
) -> list[Column]:
    """Aggregates that hold the latest (position, values) of each group and of each field sent alone."""
    groups = shapes(fields, together)
    states = [
        F.max(F.when(complete, F.struct(*position, *[fields[n].value.alias(n) for n in names]))).alias(group)
        for group, (names, complete) in groups.items()
    ]
    for name, field in fields.items():
        held = F.struct(*position, field.value.alias("_value"))
        states.append(F.max(F.when(alone(name, fields, groups), held)).alias(name))
    return states


def latest_of(
    name: str, fields: Mapping[str, Field], position: Sequence[str], together: Sequence[Sequence[str]]
) -> Column:
    """The latest (position, value) of a field from what `latest_states` holds, NULL if never sent."""
    for group, (names, _) in shapes(fields, together).items():
        if name in names:
            state = F.col(group)
            held = F.struct(*[state[p].alias(p) for p in position], state[name].alias("_value"))
            return F.greatest(F.col(name), F.when(state.isNotNull(), held))
    return F.col(name)


def merge_fields(
    messages: DataFrame,
    key: str,
    fields: Mapping[str, Field],
    position: Sequence[str] = POSITION,
    complete_only: bool = True,
    together: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Per id, the latest value of every field; a message changes only the fields it carries.

    ``position`` orders the messages and must be unique. One grouped aggregation, on a batch or
    a stream: the running state of a field is the largest (position, value) seen, so messages
    may come in any order, and an id with very many messages shrinks to one row per task before
    the shuffle. A field never spoken of has no state, which is what makes an id incomplete.
    ``together`` names fields that mostly come in one message: a message with all of them is kept
    under a single position, so that the state has a position for a message and not for a field.
    """
    merged = messages.where(F.col(key).isNotNull()).groupBy(key).agg(*latest_states(fields, position, together))
    merged = merged.select(key, *[latest_of(name, fields, position, together).alias(name) for name in fields])
    if complete_only:
        merged = merged.where(_all([F.col(n).isNotNull() for n in fields]))
    return merged.select(key, *[F.col(name)["_value"].alias(name) for name in fields])


def field_messages(log: DataFrame, schema: StructType = PEOPLE_SCHEMA, key: str = KEY) -> DataFrame:
    """Topic log to (position, key, field texts, keys of explicit NULLs).

    Rows whose text is not one JSON object, or carries no usable key, are left out;
    `monitor.message_validity` counts them by the same rule. ``3.0`` is the key 3.
    """
    texts = log.select(
        *POSITION, field_texts("value", schema.names), null_keys("value").alias("keys")
    )
    keyed = texts.withColumn(key, whole_number(F.col(f"text_{key}"), schema[key].dataType))
    return keyed.drop(f"text_{key}", f"text_{END}").where(F.col(key).isNotNull())


def schema_fields(schema: StructType = PEOPLE_SCHEMA, key: str = KEY) -> dict[str, Field]:
    """The fields that `field_messages` prepares."""
    fields = {}
    for name in schema.names:
        if name != key:
            text = F.col(f"text_{name}")
            fields[name] = Field(text, is_present(text, F.col("keys"), name))
    return fields


def sent_together(schema: StructType = PEOPLE_SCHEMA, key: str = KEY) -> list[list[str]]:
    """The fields of each topic that the schema has, without the key."""
    return [[n for n in names if n != key and n in schema.names] for names in TOPIC_FIELDS.values()]


def typed(merged: DataFrame, schema: StructType = PEOPLE_SCHEMA) -> DataFrame:
    """Merged texts as the table's types; text that does not fit becomes NULL."""
    return merged.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def merge_messages(
    log: DataFrame,
    schema: StructType = PEOPLE_SCHEMA,
    key: str = KEY,
    complete_only: bool = True,
) -> DataFrame:
    """Merge a JSON topic log into complete records with the table's schema.

    Which fields a message carries is read from the message, not from its topic. An explicit
    ``null`` counts as carried and overwrites.
    """
    messages = field_messages(log, schema, key)
    fields, together = schema_fields(schema, key), sent_together(schema, key)
    merged = merge_fields(messages, key, fields, complete_only=complete_only, together=together)
    return typed(merged, schema)


def join_topics(log: DataFrame, key: str = KEY) -> DataFrame:
    """Ids present on all topics, joined from the last whole message of each.

    The log is read and shuffled once: an aggregation by id keeps the last message per topic, and
    an id that lacks a topic has no state for it.
    """
    messages = field_messages(log.where(F.col("topic").isin(list(TOPIC_FIELDS))), key=key)
    latest = []
    for topic, names in TOPIC_FIELDS.items():
        texts = F.struct(*[F.col(f"text_{name}").alias(name) for name in names if name != key])
        seen = F.struct("timestamp", "partition", "offset", texts.alias("row"))
        latest.append(F.max(F.when(F.col("topic") == topic, seen)).alias(topic))
    joined = messages.groupBy(key).agg(*latest).dropna(how="any", subset=list(TOPIC_FIELDS))
    return typed(joined.select(key, *[f"{topic}.row.*" for topic in TOPIC_FIELDS]))
