"""Dense global positions of rows, and joins by position.

Rows are range-partitioned by sampled bounds and sorted in their partitions;
a row's position is its place in its partition plus the rows of the partitions
before it. Only one count a partition is brought together, so no task sees all
rows. The sorted rows are written once: positions must not change between their
counting and their use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

_SHIFT = 33


def with_positions(frame: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Add ``name``, 0 to n - 1 in the given order; rows that tie are placed in any order.

    Without an order rows count in the order of the frame's partitions. That is
    no order of files: for Parquet give ``*file_order()``.
    """
    if name in frame.columns:
        raise ValueError(f"The frame has a column {name!r} already")
    placed = frame.repartitionByRange(*order).sortWithinPartitions(*order) if order else frame
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_at", _SHIFT)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row a partition: this window and the broadcast are no larger.
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    joined = placed.join(F.broadcast(before), part == F.col("_part"))
    return joined.select(*frame.columns, (F.col("_before") + F.col("_at").bitwiseAND((1 << _SHIFT) - 1)).alias(name))


def file_order() -> list[Column]:
    """The order of rows in Parquet files, by path and place."""
    return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]


def join_by_position(left: DataFrame, right: DataFrame, left_order: list, right_order: list, how: str = "full") -> DataFrame:
    """position, then the columns of both: row k of one beside row k of the other.

    The longer frame's surplus rows have nulls for the other's columns; with
    ``inner`` they are left out.
    """
    if both := set(left.columns) & set(right.columns):
        raise ValueError(f"Both frames have the columns {sorted(both)}")
    return with_positions(left, *left_order).join(with_positions(right, *right_order), "position", how)
