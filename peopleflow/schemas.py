"""Table and message layouts shared by every module."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names, their order and types, and the fields of each topic.
KEY = "id_persona"

PEOPLE_SCHEMA = StructType(
    [
        StructField("id_persona", LongType()),
        StructField("nombre", StringType()),
        StructField("apellido", StringType()),
        StructField("edad", IntegerType()),
        StructField("genero", StringType()),
        StructField("ciudad", StringType()),
        StructField("estado", StringType()),
        StructField("ocupacion", StringType()),
        StructField("nivel_estudios", StringType()),
        StructField("ingreso_mensual", DoubleType()),
        StructField("activo", BooleanType()),
        StructField("fecha_registro", DateType()),
    ]
)
PEOPLE_COLUMNS = PEOPLE_SCHEMA.names

# Columns whose words the word count reads.
TEXT_COLUMNS = ["nombre", "apellido", "ciudad", "estado", "ocupacion", "nivel_estudios"]

# Which columns travel on which topic; every topic also carries the key.
TOPIC_FIELDS = {
    "personas": ["id_persona", "nombre", "apellido", "edad", "genero", "ciudad", "estado"],
    "empleos": ["id_persona", "ocupacion", "nivel_estudios", "ingreso_mensual"],
    "actividad": ["id_persona", "activo", "fecha_registro"],
}

# A topic log as read from a broker, or replayed from files.
LOG_SCHEMA = StructType(
    [
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("value", StringType()),
    ]
)

# Arrival order across topics; unique per message.
POSITION = ["timestamp", "topic", "partition", "offset"]


def topic_schema(topic: str) -> StructType:
    """Declared schema of the JSON messages on one topic."""
    return StructType([PEOPLE_SCHEMA[name] for name in TOPIC_FIELDS[topic]])
