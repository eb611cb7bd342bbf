"""What is on the topics: counters and readable lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peopleflow.functions.json_text import END, field_texts, is_message, whole_number
from peopleflow.functions.layout import money, or_text, pad_left, pad_right
from peopleflow.schemas import KEY, PEOPLE_COLUMNS, PEOPLE_SCHEMA, POSITION
from peopleflow.session import stage

# The labels of the activity line.
ACTIVE, INACTIVE = "✔ Activo  ", "✘ Inactivo"


def topic_counters(log: DataFrame, topic: str = "topic", value: str | None = None) -> DataFrame:
    """Messages per topic and over all topics; with ``value``, also those that are not one JSON object.

    The log is read once; the total is summed up from the counts per topic, which are staged.
    """
    counts = [F.count("*").alias("messages")]
    if value:
        counts.append(F.count_if(~is_message(value)).alias("malformed"))
    per_topic = stage(log.groupBy(topic).agg(*counts), "counters")
    return per_topic.withColumn("total", per_topic.agg(F.sum("messages")).scalar())


def message_validity(log: DataFrame, key: str = KEY) -> DataFrame:
    """(topic, messages, malformed, without_key, merged): what becomes of the messages in the merge.

    Malformed is what is not one JSON object: other JSON, broken text, or an object with text behind it.
    Without a key is an object whose key is missing, null or no whole number.
    """
    parsed = log.select("topic", field_texts("value", [key]))
    good = F.col(f"text_{END}").isNotNull()
    keyed = whole_number(F.col(f"text_{key}"), PEOPLE_SCHEMA[key].dataType).isNotNull()
    return parsed.groupBy("topic").agg(
        F.count("*").alias("messages"),
        F.count_if(~good).alias("malformed"),
        F.count_if(good & ~keyed).alias("without_key"),
        F.count_if(good & keyed).alias("merged"),
    )


def first_messages(log: DataFrame, limit: int) -> DataFrame:
    """The first messages in arrival order; 0 means all of them, in no order."""
    return log.orderBy(*POSITION).limit(limit) if limit > 0 else log


def _line(p: dict[str, Column]) -> Column:
    """The text for one message, by topic.

    Unknown topics and what is no JSON object are shown as they are, a missing text as ``null``.
    """
    number = F.concat(F.lit("id="), pad_right(or_text(p["id_persona"], "?"), 6))
    person = F.concat_ws(
        " | ",
        number,
        F.concat(
            or_text(p["nombre"]), F.lit(" "), pad_right(or_text(p["apellido"]), 12)
        ),
        F.concat(or_text(p["edad"]), F.lit(" años")),
        F.concat(or_text(p["ciudad"]), F.lit(", "), or_text(p["estado"])),
    )
    income = F.coalesce(p["ingreso_mensual"].try_cast("double"), F.lit(0.0))
    job = F.concat_ws(
        " | ",
        number,
        pad_right(or_text(p["ocupacion"]), 14),
        pad_right(or_text(p["nivel_estudios"]), 12),
        money(income),
    )
    active = F.coalesce(p["activo"].try_cast("boolean"), F.lit(False))
    activity = F.concat_ws(
        " | ",
        number,
        F.when(active, F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)),
        F.concat(F.lit("Registro: "), or_text(p["fecha_registro"])),
    )
    topic, shown = F.col("topic"), or_text(F.col("value"), "null")
    return (
        F.when(F.col(f"text_{END}").isNull(), shown)
        .when(topic == "personas", person)
        .when(topic == "empleos", job)
        .when(topic == "actividad", activity)
        .otherwise(shown)
    )


def monitor_lines(log: DataFrame, limit: int = 50) -> DataFrame:
    """(topic, partition, offset, line), the first ``limit`` messages or all for 0."""
    shown = first_messages(log, limit).select(
        "topic", "partition", "offset", "value", field_texts("value", PEOPLE_COLUMNS)
    )
    line = F.concat(
        F.lit("["),
        pad_right(F.col("topic"), 9),
        F.lit("] p"),
        F.col("partition").cast("string"),
        F.lit("/o"),
        pad_right(F.col("offset").cast("string"), 6),
        F.lit(" "),
        _line({name: F.col(f"text_{name}") for name in PEOPLE_COLUMNS}),
    )
    return shown.select("topic", "partition", "offset", line.alias("line"))


def raw_lines(log: DataFrame, limit: int = 30) -> DataFrame:
    """(topic, partition, offset, line) with the message text itself."""
    line = F.concat(F.lit("["), pad_left(F.col("topic"), 10), F.lit("] "), or_text(F.col("value"), "null"))
    return first_messages(log, limit).select("topic", "partition", "offset", line.alias("line"))
