"""Counts, averages and top rows of a table, and SQL over views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type) of a table, as read or inferred."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def preview(df: DataFrame, keys: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*keys).limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows."""
    return df.agg(F.count("*").alias("n_rows"))


def filter_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """How many rows meet each condition, all in one scan."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def top_groups(df: DataFrame, *keys: str, top: int = 10) -> DataFrame:
    """The largest groups, ties in key order."""
    return count_by(df, *keys).orderBy(F.desc("n"), *keys).limit(top)


def average_by(df: DataFrame, key: str, value: str, digits: int) -> DataFrame:
    """Rounded average and size of each group, highest average first."""
    average = F.round(F.avg(value), digits)
    return (
        df.groupBy(key)
        .agg(average.alias(f"avg_{value}"), F.count("*").alias("n"))
        .orderBy(F.desc(f"avg_{value}"), key)
    )


def averages_by(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Unrounded averages of several columns and the size of each group."""
    averages = [F.avg(value).alias(f"avg_{value}") for value in values]
    return df.groupBy(*keys).agg(*averages, F.count("*").alias("n"))


def group_cardinalities(df: DataFrame, **groupings: Sequence[str]) -> DataFrame:
    """How many groups each grouping has: one row, one column per grouping, one scan.

    Grouping sets bring all groupings through the same shuffle, reduced to their distinct keys
    before it; the grouping id tells them apart afterwards, also where keys are NULL.
    """
    columns = list(dict.fromkeys(name for keys in groupings.values() for name in keys))
    sets = list({frozenset(keys): list(keys) for keys in groupings.values()}.values())
    groups = df.groupingSets(sets, *columns).agg(F.grouping_id().alias("id"))
    ids = {
        name: sum(2**i for i, column in enumerate(reversed(columns)) if column not in keys)
        for name, keys in groupings.items()
    }
    return groups.agg(*[F.count_if(F.col("id") == i).alias(name) for name, i in ids.items()])


def run_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Register tables as temporary views and run a SQL text over them."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def filtered_top(
    df: DataFrame, condition: Column, columns: Sequence[str], order: Sequence[str | Column], top: int
) -> DataFrame:
    """Some columns of the first ``top`` rows that meet a condition; ``order`` should end in a key."""
    return df.where(condition).orderBy(*order).limit(top).select(*columns)


def group_report(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    order: Sequence[str | Column] = (),
    top: int | None = None,
    **measures: Column,
) -> DataFrame:
    """Measures per group of the rows that meet a condition, ordered by the keys if not told otherwise."""
    rows = df if condition is None else df.where(condition)
    groups = rows.groupBy(*keys).agg(*[measure.alias(name) for name, measure in measures.items()])
    ranked = groups.orderBy(*(order or keys))
    return ranked if top is None else ranked.limit(top)
