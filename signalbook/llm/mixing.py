"""Mixing of sources to target weights, cut at each source's exact budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbook.llm.store import SPACES, words_of

_NAMES = "key part parts before at name"
_KEY, _PART, _PARTS, _BEFORE, _AT, _NAME = (f"__mix_{c}" for c in _NAMES.split())
_KEY_BITS = 40  # of the digest; with at most 2^23 ranges a product fits 64 bits


def targets(sources: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """Per source (columns ``source``, ``source_size``, ``n``) add ``target``.

    Sources in code point order, null last, weigh ``weights`` over and over and
    share ``share`` times all sizes.  A source takes at most ``most`` times its
    size; what is over goes to the others by weight until none is above.  That
    level is found in one pass: by the ratio of ceiling to weight, the sources
    before the first that stays below its ceiling are the full ones.

    There is one row per source here, and they pass through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights))
    rows = sources.withColumn("weight", weight).withColumn("ceiling", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, later = (
        by_ratio.rowsBetween(Window.unboundedPreceding, -1),
        by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing),
    )
    everything = Window.partitionBy()
    rows = rows.withColumn("total", F.lit(share) * F.sum("source_size").over(everything)).withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("ceiling").over(earlier), F.lit(0.0))) / F.sum("weight").over(later),
    )
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("ceiling"), F.col("level"))
    return rows.withColumn("level", F.max(open_level).over(everything)).select(
        "source",
        "source_size",
        "n",
        F.least(F.col("ceiling"), F.coalesce(F.col("level") * F.col("weight"), F.col("ceiling"))).alias("target"),
    )


def mix(
    df: DataFrame,
    size: str,
    ties: list[str],
    weights: list[int],
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
) -> DataFrame:
    """Add ``source_size``, ``target`` and ``taken`` (long) to every row.

    A row's key is a digest of the seed and its ``doc_id``.  Within its source
    the keys are cut into even ranges, about as many as the root of the
    source's rows, so a hot source spreads over many tasks; sums per range give
    each range its start, a sum inside the range gives each row its place, and
    the budget cuts there.  A source takes whole passes first, then the first
    rows by key, the last of them in part: what it takes is its target, rounded
    down.  The same rows give the same result on every run; rows alike in
    ``doc_id``, ``size`` and ``ties`` may swap.  Null sizes count as 0, null
    sources as one source, null ids as empty; columns of the added names are
    replaced.
    """
    df = df.drop("source_size", "target", "taken")
    df = df.withColumn(size, F.coalesce(F.col(size), F.lit(0)).cast("bigint"))
    sums = df.groupBy("source").agg(
        F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    goals = targets(sums, weights, share, most).select(
        F.col("source").alias(_NAME),
        "source_size",
        "target",
        (F.floor(F.sqrt(F.col("n").cast("double"))) + 1).cast("bigint").alias(_PARTS),
    )
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), doc).cast("binary"))
    first_bits = F.conv(F.substring(_KEY, 1, _KEY_BITS // 4), 16, 10).cast("bigint")
    keyed = (
        df.withColumn(_KEY, digest)
        .join(goals, F.col("source").eqNullSafe(F.col(_NAME)))
        .withColumn(_PART, F.shiftright(first_bits * F.col(_PARTS), _KEY_BITS))
    )
    ranges = keyed.groupBy(F.col(_NAME), F.col(_PART)).agg(F.sum(size).alias("__mix_sum"))
    over_ranges = Window.partitionBy(_NAME).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        F.col(_NAME).alias("__mix_name2"),
        F.col(_PART).alias("__mix_part2"),
        F.coalesce(F.sum("__mix_sum").over(over_ranges), F.lit(0)).alias(_BEFORE),
    )
    in_range = (
        Window.partitionBy(_NAME, _PART)
        .orderBy(_KEY, "doc_id", size, *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = keyed.withColumn(_AT, F.sum(size).over(in_range) - F.col(size)).join(
        starts,
        F.col(_NAME).eqNullSafe(F.col("__mix_name2")) & (F.col(_PART) == F.col("__mix_part2")),
    )
    total = F.col("source_size")
    passes = F.when(total > 0, F.floor(F.col("target") / total)).otherwise(0)
    rest = F.floor(F.col("target")).cast("bigint") - passes * total
    of_last = F.least(F.col(size), F.greatest(F.lit(0), rest - F.col(_BEFORE) - F.col(_AT)))
    return placed.withColumn("taken", (passes * F.col(size) + of_last).cast("bigint")).drop(
        _KEY, _PART, _PARTS, _BEFORE, _AT, _NAME, "__mix_name2", "__mix_part2"
    )


def repeated(df: DataFrame, size: str) -> DataFrame:
    """The mix itself: each row as often as it was taken, one row per pass, the
    last one cut after the words of the last pass.  Rows taken not at all go."""
    words, taken = F.col(size), F.col("taken")
    passes = F.when(words > 0, F.ceil(taken / words)).otherwise(0).cast("int")
    rows = df.filter(taken > 0).withColumn("__mix_pass", F.explode(F.sequence(F.lit(1), passes)))
    left = taken - (F.col("__mix_pass") - 1) * words
    return rows.withColumn(
        "text", F.when(left >= words, F.col("text")).otherwise(first_words(F.col("text"), left.cast("int")))
    ).drop("__mix_pass")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    body = F.regexp_replace(text, "^" + SPACES, "")
    rest = F.get(F.split(body, SPACES, n + 1), n)
    kept = F.substring(body, F.lit(1), F.length(body) - F.length(F.coalesce(rest, F.lit(""))))
    return F.regexp_replace(kept, SPACES + "$", "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")
