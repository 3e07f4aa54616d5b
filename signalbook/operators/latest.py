"""The newest rows of each key, and loads that add to an existing table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_rows(df: DataFrame, key: str | list[str], order: list[str], n: int) -> DataFrame:
    """At most ``n`` newest rows per key, with their ``rank`` (1 = newest).

    The rank limit is applied in each map task before the shuffle
    (``WindowGroupLimit`` in the plan), so a heavy key sends ``n`` rows per
    task and no more.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def reload_from(loaded: DataFrame, column: str, overlap: int) -> int | None:
    """Where the next load begins: ``overlap`` before the highest ``column``
    loaded so far, so that rows of the boundary and rows that arrive late, by
    ``overlap`` at most, are read; None before the first load.  One value, so
    the filter the caller makes of it can reach the scan."""
    seen = loaded.agg(F.max(column)).first()[0]
    return None if seen is None else seen - overlap


def not_loaded(df: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not among the loaded ones, each once."""
    return df.dropDuplicates([key]).join(loaded.select(key), key, "left_anti")


def upsert(loaded: DataFrame, fresh: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of each key over both tables."""
    both = loaded.unionByName(fresh)
    return newest_rows(both, key, order, 1).drop("rank")
