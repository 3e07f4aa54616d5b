"""Joins and partitionings for keys that are too big for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.session import checkpointed

#: Rows of one key that one task may take before the key is split.
ROWS_PER_TASK = 2_000_000

#: Rows up to which a dimension is broadcast (some tens of MB at most).
BROADCAST_ROWS = 200_000

#: Sampled rows that make a key heavy; the count is then right to about 2 %.
SAMPLED_ROWS = 2_000

#: Ways in which rows with a null key are spread.
NULL_SPREAD = 512

#: Chunks of heavy keys per task slot of the cluster, at most; beyond that
#: chunks get longer, as more of them would only multiply shuffle blocks.
CHUNKS_PER_SLOT = 4

_SEED = 42


def heavy_keys(df: DataFrame, key: str, rows_per_task: int | None = None) -> DataFrame | None:
    """``(key, _n, _splits)`` for the keys with more than about
    ``rows_per_task`` rows; None where there is no such key.

    Only a sample of the keys is counted (all of them if ``rows_per_task`` is
    small), so that a key with very many values is not shuffled whole.  What
    counts as heavy decides how work is spread, never what comes out.  The
    result has fewer than ``rows / rows_per_task`` rows, which bounds it for
    broadcasting, and is checkpointed, as its users must agree on it.
    """
    rows_per_task = rows_per_task or ROWS_PER_TASK
    step = max(1, rows_per_task // SAMPLED_ROWS)
    keys = df.select(key)
    if step > 1:
        keys = keys.sample(1.0 / step, _SEED)
    found = (
        keys.groupBy(key)
        .agg((F.count(F.lit(1)) * step).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .withColumn("_splits", F.ceil(F.col("_n") / rows_per_task).cast("int"))
        .persist()
    )
    try:
        return None if found.isEmpty() else checkpointed(found)
    finally:
        found.unpersist()


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    spread_by: list[str] | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """``facts`` joined to ``dim`` (one row per key, any size) on ``key``.

    Where ``facts`` has heavy keys, their rows are spread over several salts
    by a hash of ``spread_by`` and the matching ``dim`` row is repeated once
    per salt.  ``how`` is ``inner`` or ``left``.
    """
    heavy = heavy_keys(facts, key, rows_per_task)
    if heavy is None:
        return facts.join(dim, key, how)
    heavy = F.broadcast(heavy.drop("_n"))
    spread = F.xxhash64(*(spread_by or [c for c in facts.columns if c != key]))
    once = F.coalesce("_splits", F.lit(1))
    ways = F.when(F.col(key).isNull(), F.lit(NULL_SPREAD)).otherwise(once)
    salted = facts.join(heavy, key, "left").withColumn("_salt", F.pmod(spread, ways.cast("bigint")).cast("int"))
    repeated = dim.join(heavy, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), once - 1)))
    return salted.drop("_splits").join(repeated.drop("_splits"), [key, "_salt"], how).drop("_salt")


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    spread_by: list[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join to a dimension that is expected to be small: broadcast once its
    size is checked, salted otherwise.  A caller who joins it several times
    passes the outcome of one :func:`is_small`."""
    if is_small(dim) if small is None else small:
        return facts.join(F.broadcast(dim), key, how)
    return salted_join(facts, dim, key, how, spread_by)


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` (:data:`BROADCAST_ROWS`) rows."""
    max_rows = max_rows or BROADCAST_ROWS
    return df.limit(max_rows + 1).count() <= max_rows


def split_heavy(
    df: DataFrame, key: str, order: list[str], rows_per_task: int | None = None, keys: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """``(light, chunks, heavy)``: the rows of keys that fit a task, the rows
    of heavier keys cut by :func:`range_chunks`, and the heavy keys.

    Where no key is heavy the result is ``(df, None, None)``.  ``keys`` is a
    cheaper table with the same keys to count, where ``df`` has been joined.
    """
    rows_per_task = rows_per_task or ROWS_PER_TASK
    heavy = heavy_keys(df if keys is None else keys, key, rows_per_task)
    if heavy is None:
        return df, None, None
    rows = heavy.agg(F.sum("_n")).first()[0]
    names = F.broadcast(heavy.select(key))
    light = df.join(names, key, "left_anti").select(*df.columns)
    large = df.join(names, key, "left_semi").select(*df.columns)
    return light, range_chunks(large, key, order, rows, rows_per_task), heavy.select(key)


def range_chunks(df: DataFrame, key: str, order: list[str], rows: int, rows_per_task: int) -> DataFrame:
    """``df`` cut into runs of about ``rows_per_task`` neighbours in
    ``(key, order)``, numbered by ``chunk`` in that order.

    The bounds come from a sample over the whole ordering, so a key of any
    size is cut by time.  Sampling may fall out differently when a plan is
    run again, hence the checkpoint: every later pass sees the same chunks.
    """
    spark = df.sparkSession
    slots = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = max(1, min(-(-rows // rows_per_task), CHUNKS_PER_SLOT * slots))
    cut = df.repartitionByRange(parts, key, *order).withColumn("chunk", F.spark_partition_id())
    return checkpointed(cut)
