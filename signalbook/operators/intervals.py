"""Sets of whole numbers as merged ranges, in tables.

A set has one row per key and run of neighbours, ``low`` to ``high``, both
included; its size grows with the gaps and not with the numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers are looked at in blocks of this size, so that a key with very many
#: of them is spread over tasks.
BLOCK = 1 << 12


def _block(column: str):
    return F.floor(F.col(column) / F.lit(BLOCK)).cast("bigint")


def ranges_of(points: DataFrame, keys: list[str], point: str) -> DataFrame:
    """The set of the values of ``point`` per key; null values are in no set.

    Runs are found block by block; only the runs of a key, at least one per
    block, meet in one task."""
    own = points.filter(F.col(point).isNotNull()).select(*keys, F.col(point).cast("bigint").alias("low")).distinct()
    own = own.withColumn("_block", _block("low"))
    in_block = Window.partitionBy(*keys, "_block").orderBy("low")
    runs = own.withColumn("_run", F.col("low") - F.row_number().over(in_block))
    runs = runs.groupBy(*keys, "_block", "_run").agg(F.min("low").alias("low"), F.max("low").alias("high"))
    return merged(runs.drop("_block", "_run"), keys)


def merged(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """The union of all ``ranges`` of a key: what overlaps or touches is one range."""
    before = Window.partitionBy(*keys).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.coalesce(F.col("low") > F.max("high").over(before) + 1, F.lit(True))
    numbered = ranges.select(*keys, "low", "high").withColumn("_new", starts)
    numbered = numbered.withColumn("_run", F.sum(F.col("_new").cast("bigint")).over(upto))
    out = numbered.groupBy(*keys, "_run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return out.drop("_run")


def outside(rows: DataFrame, ranges: DataFrame, keys: list[str], point: str) -> DataFrame:
    """The rows whose ``point`` lies in none of the ranges of its key; rows
    without a point stay, and null keys are keys.

    Ranges are cut to the blocks that occur in ``rows``, so the join has a key
    per block and no key's rows meet in one task."""
    rows = rows.withColumn("_block", _block(point))
    blocks = rows.filter("_block is not null").select(*keys, "_block").distinct().alias("b")
    spans = ranges.select(*keys, "low", "high").alias("r")
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    meets = [F.col("low") < (F.col("_block") + 1) * BLOCK, F.col("high") >= F.col("_block") * BLOCK]
    taken = blocks.join(spans, [*same, *meets]).groupBy(*[F.col(f"b.{k}").alias(k) for k in keys], "_block")
    # At most half a block of ranges.
    taken = taken.agg(F.collect_list(F.struct("low", "high")).alias("_taken")).alias("t")
    at = [F.col(f"f.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys] + [F.col("f._block") == F.col("t._block")]
    joined = rows.alias("f").join(taken, at, "left")
    within = F.exists("_taken", lambda r: (F.col(f"f.{point}") >= r.low) & (F.col(f"f.{point}") <= r.high))
    return joined.filter(F.col("_taken").isNull() | ~within).select("f.*").drop("_block")
