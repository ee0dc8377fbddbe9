"""Numbering the rows of a sorted result 0, 1, 2, … without one task seeing them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billwright.operators.storage import stored

# monotonically_increasing_id keeps the partition above the row number.
_ROW_BITS = 33


def with_position(df: DataFrame, order: list[Column], name: str = "idx") -> DataFrame:
    """Add the position of each row in the given order, which must name every column.

    The rows are stored, and their place in the files tells equal ones apart, so that
    the sort can cut anywhere. The sorted range partitions are stored as well, which
    fixes them while they are counted; a row's position is the rows in the partitions
    before its own plus its place in its own. One shuffle, by range.
    """
    columns = df.columns
    rows = stored(df, rebalance=False).withColumn("_copy", F.monotonically_increasing_id())
    fixed = stored(
        rows.orderBy(*order, "_copy").select(*columns, F.monotonically_increasing_id().alias("_at")),
        rebalance=False,
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    # One row per partition: small enough for one window and for a broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        fixed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    place = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return fixed.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + place).alias(name), *columns
    )
