"""Shards from a keyed permutation of global row numbers.

Rows get dense numbers, a Feistel network with cycle walking permutes them,
and the permuted number ``p`` gives shard ``p % n_shards`` and slot
``p // n_shards``.  Shard sizes differ by one row at most, slots have no gaps,
and anyone who knows the number of rows and the seed can compute where row
``i`` went without the table.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 8
PRIME = 2_147_483_647  # fixed: a product of two residues fits a signed 64-bit integer
WALKS = 64
_BUCKET, _KEY, _AT, _BEFORE, _NUMBER, _PLACE = (f"__shard_{c}" for c in ("bucket", "key", "at", "before", "no", "p"))


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Factor and summand of each round, from 1 to ``PRIME - 1``."""
    keys = []
    for k in range(ROUNDS):
        digest = hashlib.md5(f"{seed}:{k}".encode()).digest()
        keys.append(tuple(int.from_bytes(digest[i : i + 8], "big") % (PRIME - 1) + 1 for i in (0, 8)))
    return keys


def grid(n: int) -> tuple[int, int]:
    """Sides of the grid that holds ``n`` numbers, with less than a side to spare."""
    high = math.isqrt(max(n, 1) - 1) + 1
    return high, max(1, -(-n // high))


def permuted(number: Column, n: int, seed: int) -> Column:
    """The place of ``number`` (0 to n - 1) in the permutation of ``n`` numbers.

    Numbers that the network sends past ``n`` go through it again until they
    land inside.  A step leaves a number outside with a chance below
    ``1 / sqrt(n)``; ``WALKS`` steps are all there can be on a small grid, and
    on a large one a number still outside would raise an error.
    """
    high, wide = grid(n)
    keys = round_keys(seed)
    factors, summands = (F.array(*[F.lit(k[i]).cast("bigint") for k in keys]) for i in (0, 1))

    def network(x: Column) -> Column:
        def one_round(half: Column, k: Column) -> Column:
            def mixed(v: Column) -> Column:
                h = (v % PRIME * F.get(factors, k) + F.get(summands, k)) % PRIME
                return F.shiftright(h * h + h, 9)

            left, right = half["l"], half["r"]
            return F.when(
                k % 2 == 0, F.struct(((left + mixed(right)) % high).alias("l"), right.alias("r"))
            ).otherwise(F.struct(left.alias("l"), ((right + mixed(left)) % wide).alias("r")))

        start = F.struct(
            F.floor(x / F.lit(wide)).cast("bigint").alias("l"), (x % wide).cast("bigint").alias("r")
        )
        return F.aggregate(
            F.array(*[F.lit(k) for k in range(ROUNDS)]), start, one_round, lambda h: h["l"] * wide + h["r"]
        )

    inside = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(WALKS, high * wide - n + 1))),
        F.lit(-1).cast("bigint"),
        lambda x, step: F.when(step == 1, network(number)).when(x < n, x).otherwise(network(x)),
    )
    return inside


def numbered(df: DataFrame, key: str, ties: list[str], name: str, n: int) -> DataFrame:
    """Add ``name``: 0 to n - 1 in the order of (bucket of ``key``'s digest,
    digest, ``ties``).

    The buckets are even, as a digest is; there are about ``sqrt(n)``, so a
    bucket and the table of bucket sizes both stay small, and no sample and no
    sort of the whole is needed.  Rows alike in all these columns may swap.
    """
    n_buckets = math.isqrt(max(n, 1)) + 1
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    placed = df.withColumn(_KEY, digest).withColumn(
        _BUCKET, F.conv(F.substring(_KEY, 1, 8), 16, 10).cast("bigint") % n_buckets
    )
    sizes = placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__shard_size"))
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _BUCKET, F.coalesce(F.sum("__shard_size").over(before), F.lit(0)).alias(_BEFORE)
    )
    inside = Window.partitionBy(_BUCKET).orderBy(_KEY, *ties)
    return (
        placed.withColumn(_AT, F.row_number().over(inside) - 1)
        .join(offsets, _BUCKET)
        .withColumn(name, (F.col(_AT) + F.col(_BEFORE)).cast("bigint"))
        .drop(_KEY, _BUCKET, _AT, _BEFORE)
    )


def shard(df: DataFrame, key: str, ties: list[str], n_shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long) to every row; columns of these
    names are replaced, all others stay.

    Same rows, same result, in whatever order or partitions they come.  Null
    keys count as empty text; rows alike in ``key`` and ``ties`` are told apart
    by nothing and may swap places; an empty table stays empty.
    """
    df = df.drop("shard", "slot")
    n = df.count()
    p = F.col(_PLACE)
    return (
        numbered(df, key, ties, _NUMBER, n)
        .withColumn(_PLACE, permuted(F.col(_NUMBER), n, seed))
        .withColumn(_PLACE, F.when(p < n, p).otherwise(F.raise_error(F.lit("a cycle walk did not end"))))
        .withColumn("shard", (p % n_shards).cast("int"))
        .withColumn("slot", F.floor(p / F.lit(n_shards)).cast("bigint"))
        .drop(_NUMBER, _PLACE)
    )
