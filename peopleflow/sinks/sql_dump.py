"""A table as SQL text: one CREATE TABLE, then INSERTs of a fixed number of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peopleflow.functions.sql_text import sql_literal
from peopleflow.operators.numbering import number_rows
from peopleflow.schemas import KEY

ROWS_PER_INSERT = 500

# The column types of the exported table.
PEOPLE_SQL_TYPES = {
    "id_persona": "INT PRIMARY KEY",
    "nombre": "VARCHAR(50)",
    "apellido": "VARCHAR(50)",
    "edad": "INT",
    "genero": "CHAR(1)",
    "ciudad": "VARCHAR(50)",
    "estado": "VARCHAR(50)",
    "ocupacion": "VARCHAR(50)",
    "nivel_estudios": "VARCHAR(30)",
    "ingreso_mensual": "DECIMAL(10,2)",
    "activo": "BOOLEAN",
    "fecha_registro": "DATE",
}


def create_table_text(table: str, sql_types: Mapping[str, str]) -> str:
    """The CREATE TABLE statement, column types aligned."""
    width = max(map(len, sql_types)) + 1
    columns = ",\n".join(f"    {name:<{width}}{kind}" for name, kind in sql_types.items())
    return f"CREATE TABLE IF NOT EXISTS {table} (\n{columns}\n);\n"


def row_values(schema: StructType) -> Column:
    """All columns of a row as one comma-separated list of SQL literals."""
    return F.concat_ws(", ", *[sql_literal(F.col(f.name), f.dataType) for f in schema])


def literal_rows(df: DataFrame, key: str = KEY) -> DataFrame:
    """(key, SQL value list) per row."""
    return df.select(key, row_values(df.schema).alias("sql_values"))


def _insert_head(table: str, columns: Sequence[str]) -> str:
    return f"INSERT INTO {table} ({', '.join(columns)}) VALUES\n"


def _line(schema: StructType) -> Column:
    return F.concat(F.lit("    ("), row_values(schema), F.lit(")"))


def numbered_lines(
    numbered: DataFrame, schema: StructType, table: str, total: int, rows_per_insert: int = ROWS_PER_INSERT
) -> DataFrame:
    """A line of the script for every row with a ``row_number``, in the order of the rows.

    A row knows from its number whether it opens or closes a statement, so nothing is grouped.
    """
    number = F.col("row_number")
    opens = number % rows_per_insert == F.lit(1 % rows_per_insert)
    closes = (number % rows_per_insert == 0) | (number == total)
    text = F.concat(
        F.when(opens, F.lit(_insert_head(table, schema.names))).otherwise(F.lit("")),
        _line(schema),
        F.when(closes, F.lit(";\n")).otherwise(F.lit(",")),
    )
    return numbered.select(text.alias("value"))


def _by_batch(numbered: DataFrame, rows_per_insert: int) -> DataFrame:
    """Numbered rows with their ``batch``, whole batches together in key order.

    Typed columns are shuffled; the longer text is made afterwards.
    """
    batch = F.expr(f"(row_number - 1) div {rows_per_insert} + 1")
    return numbered.withColumn("batch", batch).repartitionByRange("batch")


def insert_statements(
    df: DataFrame,
    table: str,
    key: str = KEY,
    rows_per_insert: int = ROWS_PER_INSERT,
    presorted: bool = False,
) -> DataFrame:
    """(batch, n_rows, statement), batches counted from 1 in key order, sorted by batch.

    A group is one statement, so it never holds more than ``rows_per_insert`` rows. The
    range shuffle by batch number is also the grouping's partitioning: no second shuffle.
    """
    lines = F.sort_array("rows").getField("line")  # by row number, the first of the pair
    statement = F.concat(
        F.lit(_insert_head(table, df.columns)), F.array_join(lines, ",\n"), F.lit(";\n")
    )
    return (
        _by_batch(number_rows(df, [key], presorted=presorted), rows_per_insert)
        .select("batch", "row_number", _line(df.schema).alias("line"))
        .groupBy("batch")
        .agg(F.collect_list(F.struct("row_number", "line")).alias("rows"))
        .select(
            "batch", F.size("rows").cast("bigint").alias("n_rows"), statement.alias("statement")
        )
        .sortWithinPartitions("batch")
    )


def sql_statements(
    df: DataFrame,
    table: str = "personas",
    key: str = KEY,
    sql_types: Mapping[str, str] = PEOPLE_SQL_TYPES,
    rows_per_insert: int = ROWS_PER_INSERT,
    presorted: bool = False,
) -> DataFrame:
    """The whole dump as (batch, n_rows, statement); the CREATE TABLE is batch 0."""
    create = df.sparkSession.range(0, 1, 1, 1).select(
        F.col("id").alias("batch"),
        F.lit(0).cast("bigint").alias("n_rows"),
        F.lit(create_table_text(table, sql_types)).alias("statement"),
    )
    inserts = insert_statements(df, table, key, rows_per_insert, presorted)
    return create.unionByName(inserts)


def script_lines(
    df: DataFrame,
    table: str = "personas",
    key: str = KEY,
    sql_types: Mapping[str, str] = PEOPLE_SQL_TYPES,
    rows_per_insert: int = ROWS_PER_INSERT,
    presorted: bool = False,
) -> DataFrame:
    """The same dump as text rows in script order, one per table row."""
    numbered = number_rows(df, [key], presorted=presorted)
    rows = _by_batch(numbered, rows_per_insert).sortWithinPartitions("row_number")
    total = numbered.agg(F.max("row_number")).scalar()
    lines = numbered_lines(rows, df.schema, table, total, rows_per_insert)
    return _create_line(df.sparkSession, table, sql_types).unionByName(lines)


def _create_line(spark: SparkSession, table: str, sql_types: Mapping[str, str]) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.lit(create_table_text(table, sql_types)).alias("value"))


def write_sql(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """Write the dump as a folder of text files; read in file order it is one script.

    No statement is split between files.
    """
    script_lines(df, **options).write.mode(mode).text(path)


def write_blocks(
    blocks: DataFrame,
    schema: StructType,
    path: str,
    mode: str = "errorifexists",
    table: str = "personas",
    sql_types: Mapping[str, str] = PEOPLE_SQL_TYPES,
    rows_per_insert: int = ROWS_PER_INSERT,
) -> None:
    """`write_sql` of rows that are numbered and in order, in partitions of whole statements. No shuffle."""
    total = blocks.agg(F.max("row_number")).first()[0] or 0
    lines = numbered_lines(blocks, schema, table, total, rows_per_insert)
    _create_line(blocks.sparkSession, table, sql_types).unionByName(lines).write.mode(mode).text(path)
