"""The inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from peopleflow.operators.messages import fanout
from peopleflow.operators.synth import people_of
from peopleflow.schemas import KEY, LOG_SCHEMA, TOPIC_FIELDS

EVENT_TYPES = ["view", "signup", "error", "click", "purchase"]


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated person per customer."""
    return people_of(table(spark, sf_dir, "customer").selectExpr(f"c_custkey + 1 AS {KEY}"))


def _envelope(messages: DataFrame, sequence: str, at: str) -> DataFrame:
    """Give (topic, value) messages the columns of a topic log with three partitions."""
    return messages.selectExpr(
        "topic",
        f"cast(pmod({sequence}, 3) AS int) AS partition",
        f"{sequence} div 3 AS offset",
        f"{at} AS timestamp",
        "value",
    )


def _seconds_after(day: str, seconds: str) -> str:
    return f"TIMESTAMP_NTZ '{day} 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"


def _object(**fields: str) -> str:
    pairs = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"to_json(named_struct({pairs}), map('ignoreNullFields', 'false')) AS value"


def people_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every person's three messages, sent once."""
    sent = fanout(people(spark, sf_dir), keep=[KEY])
    return _envelope(sent, KEY, _seconds_after("1990-01-01", KEY))


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole activity message per order of the customer, at the order's date."""
    value = _object(
        id_persona="o_custkey + 1",
        activo="o_orderstatus <> 'F'",
        fecha_registro="cast(o_orderdate AS date)",
    )
    orders = table(spark, sf_dir, "orders")
    sent = orders.selectExpr("o_orderkey", "o_orderdate", "'actividad' AS topic", value)
    return _envelope(sent, "o_orderkey", "o_orderdate")


def income_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partial job message per order: the income alone, an explicit null while pending."""
    value = _object(
        id_persona="o_custkey + 1",
        ingreso_mensual="CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END",
    )
    orders = table(spark, sf_dir, "orders")
    sent = orders.selectExpr("o_orderkey", "o_orderdate", "'empleos' AS topic", value)
    return _envelope(sent, "o_orderkey", "o_orderdate")


def supplier_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers under negative ids; they never send activity, so they stay incomplete."""
    ids = table(spark, sf_dir, "supplier").selectExpr(f"-s_suppkey - 1 AS {KEY}")
    topics = {topic: TOPIC_FIELDS[topic] for topic in ("personas", "empleos")}
    sent = fanout(people_of(ids), topics, keep=[KEY])
    return _envelope(sent, f"(-{KEY})", _seconds_after("1989-01-01", f"-{KEY}"))


def noise_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages on the personas topic that are no JSON: the part names."""
    parts = table(spark, sf_dir, "part")
    sent = parts.selectExpr("p_partkey", "'personas' AS topic", "p_name AS value")
    return _envelope(sent, "p_partkey", _seconds_after("1988-01-01", "p_partkey"))


def odd_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four kinds of activity messages, one per part: text behind the object, a whole number with a
    point as id, no id, and two objects in one message."""
    whole = "'{\"id_persona\":' || {id} || ',\"activo\":true,\"fecha_registro\":\"2020-01-01\"}'"
    value = f"""CASE p_partkey % 4
        WHEN 0 THEN {whole.replace("{id}", "(p_partkey + 1)")} || ' trailing'
        WHEN 1 THEN {whole.replace("{id}", "(p_partkey + 1) || '.0'")}
        WHEN 2 THEN '{{"activo":false}}'
        ELSE '{{"id_persona":1}}{{"id_persona":2}}' END AS value"""
    parts = table(spark, sf_dir, "part")
    sent = parts.selectExpr("p_partkey", "'actividad' AS topic", value)
    return _envelope(sent, "p_partkey", _seconds_after("1999-01-01", "p_partkey"))


def _union(*logs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, logs).select(*LOG_SCHEMA.names)


def whole_message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that carry all fields of their topic; activity is sent again and again."""
    return _union(
        people_log(spark, sf_dir), activity_log(spark, sf_dir), supplier_log(spark, sf_dir)
    )


def full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The above, plus partial messages, explicit nulls and malformed text."""
    return _union(
        whole_message_log(spark, sf_dir), income_log(spark, sf_dir), noise_log(spark, sf_dir)
    )
