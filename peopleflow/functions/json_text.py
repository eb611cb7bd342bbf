"""JSON text to columns and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def object_text(*columns: str | Column) -> Column:
    """One JSON object per row; NULL fields are written as ``null``, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


# A field that no message carries, put at the end of a message to see whether it is one.
END = "peopleflow_end"

_BLANKS = " \t\n\r"


def closed(value: str | Column) -> Column:
    """A JSON object with a last field more; what is none does not get that field.

    JSON functions stop where the first object ends and ignore the rest. With the field put before
    the last brace, an object that ends earlier, or not at all, lacks it. NULL without a last brace.
    Most messages have no blanks around the last brace, and are not searched for them.
    """
    value = F.col(value) if isinstance(value, str) else value
    own = ~F.contains(value, F.lit(END))
    loose = [value.endswith(f"{before}}}") for before in f"{_BLANKS}{{"]
    plain = value.endswith("}") & ~reduce(Column.__or__, loose)
    most = F.substring(value, F.lit(1), F.length(value) - 1)
    text = F.rtrim(value, F.lit(_BLANKS))
    head = F.rtrim(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(_BLANKS))
    comma = F.when(head.endswith("{"), F.lit("")).otherwise(F.lit(","))
    searched = F.when(text.endswith("}") & own, F.concat(head, comma, F.lit(f'"{END}":7}}')))
    return F.when(plain & own, F.concat(most, F.lit(f',"{END}":7}}'))).otherwise(searched)


def is_message(value: str | Column) -> Column:
    """Whether a text is one JSON object and nothing else; false for NULL.

    The same rule as that of ``text_peopleflow_end`` in `field_texts`.
    """
    return F.coalesce(F.get_json_object(closed(value), f"$.{END}") == "7", F.lit(False))


def field_texts(value: str | Column, names: Sequence[str]) -> Column:
    """The named fields of a JSON object as text columns ``text_<name>``, parsed in one go.

    A field that is absent and one that is ``null`` both come back NULL; `null_keys` tells them
    apart. Text that is no message gives NULLs, and ``text_peopleflow_end`` is NULL only there.
    Being a generator, it also keeps filters on the fields from being pushed below it, which would
    parse the message a second time.
    """
    names = [*names, END]
    return F.json_tuple(closed(value), *names).alias(*[f"text_{name}" for name in names])


def whole_number(text: Column, dtype) -> Column:
    """A number text as a whole number, ``3.0`` and ``3e0`` like ``3``; NULL if it is none."""
    wide = text.try_cast("decimal(38,10)")
    return F.coalesce(text.try_cast(dtype), F.when(wide == F.floor(wide), F.floor(wide).try_cast(dtype)))


def null_keys(value: str | Column) -> Column:
    """All keys of a JSON object if it may hold an explicit ``null``, else NULL.

    Text without the word ``null`` needs no second parse: its fields are present exactly when
    their text is.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.contains(value, F.lit("null")), F.json_object_keys(value))


def is_present(text: Column, keys: Column, name: str) -> Column:
    """Whether the object carries the field, explicit ``null`` included."""
    return text.isNotNull() | F.coalesce(F.array_contains(keys, name), F.lit(False))
