"""Fixed-width text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_right(text: Column, width: int) -> Column:
    """Fill with blanks up to ``width``; longer text stays whole."""
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def pad_left(text: Column, width: int) -> Column:
    """Fill with blanks on the left up to ``width``; longer text stays whole."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def money(amount: Column) -> Column:
    """Dollar amount with thousands separators and two decimals."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def or_text(column: Column, default: str = "") -> Column:
    """Text of a column, or a default for NULL."""
    return F.coalesce(column.cast("string"), F.lit(default))
