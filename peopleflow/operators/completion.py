"""The first N ids to become complete, as they stood at that moment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peopleflow.operators.merge import (
    Field,
    alone,
    field_messages,
    merge_fields,
    schema_fields,
    sent_together,
    shapes,
    typed,
)
from peopleflow.operators.numbering import number_rows
from peopleflow.schemas import KEY, PEOPLE_SCHEMA, POSITION
from peopleflow.session import stage
from peopleflow.sources.snapshot import pinned


def first_states(
    fields: Mapping[str, Field], position: Sequence[str], together: Sequence[Sequence[str]] = ()
) -> list[Column]:
    """Aggregates that hold when each group of fields, and each field without its group, was first sent."""
    at, groups = F.struct(*position), shapes(fields, together)
    first = [F.min(F.when(complete, at)).alias(f"first{group}") for group, (_, complete) in groups.items()]
    return first + [F.min(F.when(alone(n, fields, groups), at)).alias(f"first_{n}") for n in fields]


def done_position(fields: Mapping[str, Field], together: Sequence[Sequence[str]] = ()) -> Column:
    """From `first_states`, the position at which the last field was first sent; NULL if one never was."""
    known = {name: F.col(f"first_{name}") for name in fields}
    for group, (names, _) in shapes(fields, together).items():
        known |= {name: F.least(known[name], F.col(f"first{group}")) for name in names}
    complete = reduce(Column.__and__, [c.isNotNull() for c in known.values()])
    return F.when(complete, F.greatest(*known.values()) if len(known) > 1 else next(iter(known.values())))


def completions(
    messages: DataFrame,
    key: str,
    fields: Mapping[str, Field],
    position: Sequence[str] = POSITION,
    together: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """(key, position): when each id first had every field. Ids never complete are left out."""
    first = messages.where(F.col(key).isNotNull()).groupBy(key).agg(*first_states(fields, position, together))
    done = first.select(key, done_position(fields, together).alias("done"))
    return done.where(F.col("done").isNotNull()).select(key, "done.*")


def nth_completion(done: DataFrame, n: int, position: Sequence[str] = POSITION) -> DataFrame:
    """The position at which the N-th id became complete; no row if fewer did."""
    places = number_rows(done.select(*position), position)
    return places.where(F.col("row_number") == n).select(*position)


def first_n_complete(
    messages: DataFrame,
    key: str,
    fields: Mapping[str, Field],
    n: int,
    position: Sequence[str] = POSITION,
    together: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """The first N complete ids, merged from the messages up to the N-th completion only.

    If fewer than N ids ever complete, all messages count. The cut is one staged row, so the
    log is read twice at most; the second read pushes the cut's leading column into the scan.
    Both reads must see the same messages: of a log that still grows, pass a pinned one.
    """
    done = completions(messages, key, fields, position, together)
    cut = stage(nth_completion(done, n, position), "cut")
    if not cut.isEmpty():
        lead = position[0]
        # An aggregate, so that it stays a subquery of its own, which a scan can push down.
        messages = messages.where(F.col(lead) <= cut.agg(F.max(lead)).scalar())
        messages = messages.where(F.struct(*position) <= cut.select(F.struct(*position)).scalar())
    return merge_fields(messages, key, fields, position, together=together)


def first_n_records(
    log: DataFrame, n: int, schema: StructType = PEOPLE_SCHEMA, key: str = KEY
) -> DataFrame:
    """`first_n_complete` for a JSON topic log, as of now: what arrives meanwhile does not count."""
    messages = field_messages(pinned(log), schema, key)
    fields, together = schema_fields(schema, key), sent_together(schema, key)
    return typed(first_n_complete(messages, key, fields, n, together=together), schema)
