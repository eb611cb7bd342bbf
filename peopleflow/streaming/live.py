"""Live counts per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from peopleflow.operators.messages import parse_messages
from peopleflow.schemas import KEY, topic_schema


def live_counts(rows: DataFrame, key: str, value: str, digits: int = 1) -> DataFrame:
    """Running count and rounded average per group. The state is one row per group, for good."""
    average = F.round(F.avg(value), digits)
    return rows.groupBy(key).agg(F.count("*").alias("n"), average.alias(f"avg_{value}"))


def ranked(counts: DataFrame, key: str) -> DataFrame:
    """Largest group first. On a stream this needs complete mode.

    A sorted micro-batch runs its aggregation twice, once to sample the range bounds, so this is
    for reports shown as they are; a stored report is better sorted by its reader.
    """
    return counts.orderBy(F.desc("n"), key)


def person_messages(log: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """The rows of the personas topic by its declared schema."""
    declared = StructType(
        [
            StructField(KEY, IntegerType()) if field.name == KEY else field
            for field in topic_schema("personas")
        ]
    )
    people = log.where(F.col("topic") == "personas")
    return parse_messages(people, declared, drop_malformed=drop_malformed)


def live_people_by_state(log: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """People per state as their messages arrive; bad messages count under the NULL state."""
    return live_counts(person_messages(log, drop_malformed), "estado", "edad")
