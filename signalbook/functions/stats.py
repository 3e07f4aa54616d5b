"""Moving statistics over integer amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moments(amount: Column):
    """Count, sum and sum of squares: exact in whole numbers, so the result
    does not depend on the order in which partial aggregates merge."""
    x = amount.cast("bigint")
    return F.count(x), F.sum(x), F.sum(x * x)


def mean_of(n: Column, s1: Column) -> Column:
    return F.try_divide(s1.cast("double"), n.cast("double"))


def stddev_pop_of(n: Column, s1: Column, s2: Column) -> Column:
    """Population standard deviation; 0 (not null) for a single row, since a
    null control limit would switch the amount rule off."""
    spread = (n * s2 - s1 * s1).cast("double")
    return F.try_divide(F.sqrt(spread), n.cast("double"))
