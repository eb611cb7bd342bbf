"""One finished table in all three file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame

from peopleflow.operators.numbering import in_blocks, number_rows
from peopleflow.schemas import KEY
from peopleflow.session import stage
from peopleflow.sinks.files import export_sizes, write_csv, write_json
from peopleflow.sinks.sql_dump import ROWS_PER_INSERT, write_blocks


def export_people(
    df: DataFrame, folder: str, name: str = "personas", mode: str = "errorifexists"
) -> DataFrame:
    """Write JSON, CSV and SQL folders in key order; returns their sizes.

    The table is staged first, so a costly source (a merge of topics) runs once. The rows are put in
    key order by one range shuffle, which also numbers them; the numbers then place them in
    partitions of whole INSERTs, from which all three formats are written as they lie. Files
    follow the key order. An empty table is an error and nothing is written.
    """
    spark = df.sparkSession
    ready = stage(df, "export")
    total = ready.count()
    if not total:
        raise ValueError("no complete records to export")
    paths = {kind: f"{folder}/{name}.{kind}" for kind in ("json", "csv", "sql")}
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inserts = -(-total // (ROWS_PER_INSERT * files))
    blocks = in_blocks(number_rows(ready, [KEY]), inserts * ROWS_PER_INSERT)
    rows = blocks.select(*ready.columns)
    write_json(rows, paths["json"], mode)
    write_csv(rows, paths["csv"], mode)
    write_blocks(blocks, ready.schema, paths["sql"], mode)
    return export_sizes(spark, paths)
