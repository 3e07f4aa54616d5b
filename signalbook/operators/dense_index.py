"""Consecutive numbers over a total order, without one task or the driver
seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbook.session import checkpointed

_POSITION_BITS = 33  # fixed: monotonically_increasing_id keeps the row in the low 33 bits


def dense_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... in ``order``, which must be total.

    A global sort puts the rows in range partitions; the number of a row is
    its place in its partition plus the sizes of the partitions before it.
    The sorted rows are checkpointed, as the two uses must see one layout.
    """
    placed = checkpointed(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", _POSITION_BITS))
    # One row per partition of the sort.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (place + F.col("_before")).cast("int"))
        .drop("_at", "_part", "_before")
    )
