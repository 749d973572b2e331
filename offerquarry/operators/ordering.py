"""Positions of rows in a global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerquarry.sources.shared import write_and_read


def with_position(
    df: DataFrame, order_by: Sequence[Column], name: str = "position"
) -> DataFrame:
    """Number all rows 1, 2, 3, ... in the given order, in parallel.

    Rows are split into ranges of the order and sorted there; the sorted ranges
    are written once, so that counting and numbering see the same split.  The
    number of a row is its place in its range plus the size of all earlier
    ranges.  Ties should be broken in ``order_by``: then equal prices spread over
    several ranges.
    """
    ranges = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    ranges = write_and_read(ranges, "sorted")
    # One row per range, so never more than there are shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select(
            "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
        )
    )
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_range", "_place", "_before")
    )
