"""JSON Lines and CSV folders, and their sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines with every field of every row, NULLs included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, lower-case booleans and values kept blank for blank."""
    df.write.mode(mode).options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def rendered_bytes(df: DataFrame) -> DataFrame:
    """(format, bytes): what the rows take as JSON Lines and as CSV, line ends included, headers not.

    Rendered, not written, so that a listing of files can be checked against it.
    """
    json = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    csv = F.to_csv(F.struct(*df.columns), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    sums = df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("format"), (F.octet_length(line) + 1).alias("size"))
        for name, line in (("json", json), ("csv", csv))
    ])))
    return sums.groupBy("format").agg(F.sum("size").alias("bytes"))


def export_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Non-empty files, bytes and megabytes per exported format. Lists files, reads none."""
    listed = [
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select(F.lit(name).alias("format"), "length")
        for name, path in paths.items()
    ]
    return (
        reduce(DataFrame.unionByName, listed)
        .groupBy("format")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .withColumn("megabytes", F.round(F.col("bytes") / 1048576.0, 1))
    )
