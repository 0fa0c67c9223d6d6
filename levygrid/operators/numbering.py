"""Dense row numbers inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from levygrid.operators.lookup import Dimension, lookup_join
from levygrid.operators.stages import durable

_BROADCAST = 32 << 20


def number_rows(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Add the 1-based position of each row in its group, in the given order.

    A window per group would pull a whole group into one task. Here the rows are range
    partitioned over group and order (input position breaks ties, so equal rows spread
    too), written once, and numbered by position in the partition plus the group's row
    count in earlier partitions. Only one row per partition and group is windowed.
    """
    keys = [F.col(g) for g in group]
    placed = (
        df.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, *order, F.col("__tie"))
        .sortWithinPartitions(*keys, *order, F.col("__tie"))
        .drop("__tie")
        .withColumn("__pos", F.monotonically_increasing_id())
    )
    return offset_rows(durable(placed), group, F.shiftright("__pos", 33), F.col("__pos"), name)


def offset_rows(
    df: DataFrame, group: list[str], block: Column, position: Column, name: str
) -> DataFrame:
    """Number rows that lie consecutively, by ``position``, in ordered blocks.

    The starts of blocks are measured; the rows only move if those are too many to broadcast.
    """
    df = df.withColumns({"__block": block, "__at": position})
    earlier = W.partitionBy(*group).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        df.groupBy(*group, "__block")
        .agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
        .drop("__rows")
    )
    number = F.col("__at") - F.col("__first") + F.col("__before") + 1
    known = Dimension(starts, [*group, "__block"], _BROADCAST)
    return (
        lookup_join(df, known, {c: F.col(c) for c in [*group, "__block"]}, "inner", ["__at"])
        .withColumn(name, number)
        .drop("__block", "__at", "__first", "__before", "__pos")
    )
