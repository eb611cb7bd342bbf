"""Values as SQL literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, FractionalType, NumericType


def _plain_number(column: Column) -> Column:
    """The shortest text of a fractional number, its exponent, if it has one, written out as zeros.

    One rendering at every size: the digits are those of the text, and the point moves.
    """
    text = column.cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?([\d.]+)E", 1), r"\.0?$|\.", "")
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    whole = F.when(F.length(digits) > power, digits).otherwise(F.rpad(digits, power + 1, "0"))
    cut = F.concat(F.substring(whole, F.lit(1), power + 1), F.lit("."))
    large = F.concat(cut, F.when(F.length(whole) > power + 1, F.substring(whole, power + 2, F.length(whole))).otherwise(F.lit("0")))
    plain = F.concat(sign, F.when(power < 0, small).otherwise(large))
    return F.when(F.contains(text, F.lit("E")), plain).otherwise(text)


def sql_literal(column: Column, dtype: DataType) -> Column:
    """TRUE/FALSE for booleans, bare numbers, quoted text for the rest, NULL for NULL."""
    if isinstance(dtype, BooleanType):
        literal = F.when(column, F.lit("TRUE")).otherwise(F.lit("FALSE"))
    elif isinstance(dtype, FractionalType) and dtype.typeName() in ("double", "float"):
        unnamed = F.isnan(column) | (F.abs(column) == float("inf"))
        quoted = F.concat(F.lit("'"), column.cast("string"), F.lit("'"))
        literal = F.when(unnamed, quoted).otherwise(_plain_number(column))
    elif isinstance(dtype, NumericType):
        literal = column.cast("string")
    else:
        escaped = F.replace(column.cast("string"), F.lit("'"), F.lit("''"))
        literal = F.concat(F.lit("'"), escaped, F.lit("'"))
    return F.when(column.isNull(), F.lit("NULL")).otherwise(literal)
