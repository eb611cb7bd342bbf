"""Global row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peopleflow.session import shared_dir, stage

# monotonically_increasing_id() = partition number * 2^33 + row number in the partition
_PARTITION_BITS = 33


def number_rows(
    df: DataFrame, keys: Sequence[str], name: str = "row_number", presorted: bool = False
) -> DataFrame:
    """Number the rows 1, 2, ... in the order of ``keys``, which must be unique.

    ``presorted`` says that ``df`` is range-partitioned and sorted by the keys already.

    The rows are range-partitioned and sorted, every row takes its place inside its partition,
    and the result is staged so that a lost task cannot draw other range bounds. What joins back
    is one offset per partition: at most ``spark.sql.shuffle.partitions`` rows, so it is
    broadcast, and its running sum is the only window.
    """
    ordered = df if presorted else df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(
        ordered.withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _PARTITION_BITS))
        .withColumn("_place", F.col("_place").bitwiseAND((1 << _PARTITION_BITS) - 1)),
        "numbered",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_part", "_place", "_offset")
    )


def in_blocks(numbered: DataFrame, rows: int, name: str = "row_number") -> DataFrame:
    """Numbered rows, a partition for every ``rows`` of them, in order within and between partitions.

    No partition starts inside a block. Written to checkpoint storage, so that any number of writers
    read the same partitions without moving a row again.
    """
    spark = numbered.sparkSession
    last = numbered.agg(F.max(name)).first()[0] or 0
    block = F.expr(f"cast(({name} - 1) div {rows} AS int)")
    placed = numbered.repartitionById(max(1, -(-last // rows)), block).sortWithinPartitions(name)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return placed.checkpoint()
