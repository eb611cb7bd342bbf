"""JSON Lines and CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from peopleflow.schemas import PEOPLE_SCHEMA


def read_json(
    spark: SparkSession, path: str, schema: StructType | None = PEOPLE_SCHEMA
) -> DataFrame:
    """JSON Lines with a declared schema; ``schema=None`` infers one with an extra pass."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = PEOPLE_SCHEMA,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header line; ``schema=None`` infers one with an extra pass.

    A blank field is NULL and a quoted blank the empty string: the null marker is a character no
    text holds, so the two stay apart. ``multiline`` allows line breaks inside quoted values, at
    the price of unsplittable files.
    """
    reader = spark.read.options(
        header=True, escape='"', nullValue="\u0000", multiLine=multiline
    )
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)
