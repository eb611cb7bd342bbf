"""Word splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(*columns: str | Column) -> Column:
    """Lower-cased, blank-separated tokens of several text columns; NULL columns are skipped.

    Leading or trailing blanks leave an empty token, which callers filter out.
    """
    return F.split(F.lower(F.concat_ws(" ", *columns)), r"\s+")
