"""Rows to topic messages and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peopleflow.functions.json_text import is_message, object_text
from peopleflow.schemas import TOPIC_FIELDS


def fanout(
    df: DataFrame,
    topics: Mapping[str, Sequence[str]] = TOPIC_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Each row as one JSON message per topic: (keep..., topic, value). One pass, no shuffle."""
    messages = [
        F.struct(F.lit(topic).alias("topic"), object_text(*fields).alias("value"))
        for topic, fields in topics.items()
    ]
    return df.select(*keep, F.inline(F.array(*messages)))


def parse_messages(
    messages: DataFrame,
    schema: StructType,
    value: str = "value",
    keep: Sequence[str] = (),
    drop_malformed: bool = False,
) -> DataFrame:
    """Unpack JSON messages by a declared schema.

    Text that is no JSON object gives a row of NULLs, a field of the wrong type a NULL in that
    field. ``drop_malformed`` leaves out what is not one JSON object and nothing else, not the latter.
    """
    text = F.col(value).cast("string")
    if drop_malformed:
        messages = messages.where(is_message(text))
    return messages.select(*keep, F.from_json(text, schema).alias("p")).select(*keep, "p.*")
