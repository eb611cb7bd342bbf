"""Reading sorted partitions group by group, and components of a graph."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peopleflow.session import stage


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, one table a key, from a partition sorted by its (number) keys.

    Holds one group and one batch at a time.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        first = tuple(c[0] for c in columns)
        borders = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(borders, borders[1:]):
            if (a or first != last) and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Merge the groups of ``labels`` (``node, label``) that ``edges`` (``a, b``) join.

    Labels are node numbers, and a group's label is its smallest. Each round every group takes the
    smallest label among its neighbours, and that label's own new one if it has one, so chains
    shorten by half. Edges between groups are rewritten to the new labels, and those inside a group
    are dropped, so later rounds read few. All steps are aggregations that shrink in their tasks,
    and joins of written tables, which adaptive execution splits where a group is large. Nothing is
    collected.
    """
    left, right = (labels.select(F.col("node").alias(k), F.col("label").alias(f"label_{k}")) for k in ("a", "b"))
    between = edges.join(left, "a").join(right, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    between = between.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    between = stage(between.distinct(), "edges")
    # A group's smallest neighbour matters only if it is smaller, so edges lead downwards.
    while not between.isEmpty():
        moves = stage(between.groupBy(F.col("a").alias("label")).agg(F.min("b").alias("next")), "moves")
        further = moves.select(F.col("label").alias("next"), F.col("next").alias("further"))
        moves = moves.join(further, "next", "left").select("label", F.coalesce("further", "next").alias("next"))
        moves = stage(moves, "moves")
        labels = labels.join(moves, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        labels = stage(labels, "labels")
        for end in ("a", "b"):
            new = moves.select(F.col("label").alias(end), F.col("next").alias(f"new_{end}"))
            between = between.join(new, end, "left").withColumn(end, F.coalesce(f"new_{end}", end)).drop(f"new_{end}")
        between = between.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        between = stage(between.distinct(), "edges")
    return labels
