"""Word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peopleflow.functions.words import tokens
from peopleflow.schemas import TEXT_COLUMNS


def words(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """One row per non-empty word of the text columns."""
    return df.select(F.explode(tokens(*columns)).alias("word")).where(F.col("word") != "")


def word_count(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """How often each word occurs; frequent words are summed up before the shuffle."""
    return words(df, columns).groupBy("word").agg(F.count("*").alias("n"))


def top_words(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS, top: int = 20) -> DataFrame:
    """The most frequent words, ties in alphabetical order."""
    return word_count(df, columns).orderBy(F.desc("n"), "word").limit(top)


def distinct_words(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Number of different words."""
    return words(df, columns).distinct().agg(F.count("*").alias("distinct_words"))
