"""Consecutive numbers over a global order, without sorting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.session import materialise

# monotonically_increasing_id keeps the row position in the lower 33 bits.
_POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``: 1, 2, 3 … in the given order.

    The rows are range-partitioned, sorted per partition and written once with
    their position; the number is that position plus the rows before the
    partition. Only one count per partition is summed in a single task.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    stored = materialise(placed, "numbering").select(
        *df.columns,
        F.shiftright("_id", _POSITION_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
    )
    # One row per partition: bounded by the number of partitions, not the data.
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return stored.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_position") + 1).alias(name)
    )
