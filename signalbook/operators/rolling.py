"""Trailing statistics over the last rows of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalbook.functions.stats import mean_of, moments, stddev_pop_of
from signalbook.operators.skew import split_heavy


def trailing_stats(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    length: int = 10,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add the count, mean and deviation of ``value`` over each row and the
    ``length - 1`` rows before it of the same key.

    One window does it for keys that fit a task.  Heavier keys are cut into
    chunks by ``order``, each given the rows just before it, so that no task
    gets a whole key.
    """
    light, chunks, _ = split_heavy(df, key, order, rows_per_task)
    if chunks is None:
        return _over(df, [key], order, value, length)
    lead = _rows_before(chunks, key, order, value, length - 1)
    padded = chunks.withColumn("_lead", F.lit(False)).unionByName(lead, allowMissingColumns=True)
    split = _over(padded, [key, "chunk"], order, value, length).filter(~F.col("_lead"))
    return _over(light, [key], order, value, length).unionByName(split.drop("_lead", "chunk"))


def _over(df: DataFrame, partition: list[str], order: list[str], value: str, length: int) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(1 - length, 0)
    n, s1, s2 = (c.over(w) for c in moments(F.col(value)))
    sums = df.withColumns({"n": n, "_s1": s1, "_s2": s2})
    out = sums.withColumns(
        {
            "moving_avg": mean_of(F.col("n"), F.col("_s1")),
            "moving_std": stddev_pop_of(F.col("n"), F.col("_s1"), F.col("_s2")),
        }
    )
    return out.drop("_s1", "_s2")


def _rows_before(chunks: DataFrame, key: str, order: list[str], value: str, n: int) -> DataFrame:
    """For each chunk of a key, the last ``n`` rows of that key in earlier
    chunks.  Only the ends of chunks are looked at: ``n`` rows each."""
    newest = Window.partitionBy(key, "chunk").orderBy(*[F.col(c).desc() for c in order])
    ends = (
        chunks.select(key, "chunk", *order, value)
        .withColumn("_back", F.row_number().over(newest))
        .filter(F.col("_back") <= n)
    )
    in_order = Window.partitionBy(key).orderBy(*order)
    first_of_chunk = F.coalesce(F.lag("chunk").over(in_order) != F.col("chunk"), F.lit(True))
    earlier = F.collect_list(F.struct(*order, value)).over(in_order.rowsBetween(-n, -1))
    return (
        ends.withColumns({"_first": first_of_chunk, "_earlier": earlier})
        .filter("_first")
        .select(key, "chunk", F.explode("_earlier").alias("_e"))
        .select(key, "chunk", "_e.*", F.lit(True).alias("_lead"))
    )
