"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for every node in
    ``links`` (columns ``a``, ``b``, long).

    Each round moves every node's larger neighbours to its smallest one, then
    ties the smaller ones together; the links become stars within few rounds,
    about the logarithm of the longest path.  A round is two aggregations and
    two joins, its result a stored table, so no node's links meet in one task.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Larger neighbours of a node point to its smallest one.
        large = (
            both.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # A node and its smaller neighbours point to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                      F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .filter("a <> b")
            .distinct()
        )
        edges = stored(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
