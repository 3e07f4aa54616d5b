"""Sets of numbers as ranges, against sets."""

import random

import pytest

from signalbook.operators import intervals
from signalbook.operators.intervals import merged, outside, ranges_of

KEYS = ["topic", "partition"]
POINT = "topic string, partition int, offset bigint"


def sets(rows):
    out = {}
    for *key, n in rows:
        if n is not None:
            out.setdefault(tuple(key), set()).add(n)
    return out


def spelled(ranges):
    rows = [(*(r[k] for k in KEYS), n) for r in ranges.collect() for n in range(r.low, r.high + 1)]
    assert len(rows) == len(set(rows))  # no two ranges of a key overlap
    return sets(rows)


@pytest.fixture(params=[1, 4, 1 << 12])
def block(request, monkeypatch):
    monkeypatch.setattr(intervals, "BLOCK", request.param)


def test_points_become_ranges_and_ranges_points(spark, block):
    draw = random.Random(1)
    points = [("t", draw.randrange(3), draw.randrange(-20, 60)) for _ in range(150)]
    points += [(None, 0, 5), (None, 0, 6), ("t", None, 7), ("u", 1, None), ("u", 1, 1 << 40), ("u", 1, (1 << 40) + 1)]
    ranges = ranges_of(spark.createDataFrame(points, POINT).repartition(4), KEYS, "offset")
    assert spelled(ranges) == sets(points)
    gaps = sum(n - 1 not in s for s in sets(points).values() for n in s)
    assert ranges.count() == gaps  # it grows with gaps, not with points


def test_union_of_ranges(spark):
    rows = [("t", 0, 0, 9), ("t", 0, 2, 3), ("t", 0, 10, 12), ("t", 0, 14, 20), ("t", 0, 14, 20), ("t", 1, 13, 13)]
    got = merged(spark.createDataFrame(rows, "topic string, partition int, low bigint, high bigint"), KEYS)
    assert sorted(map(tuple, got.collect())) == [("t", 0, 0, 12), ("t", 0, 14, 20), ("t", 1, 13, 13)]


def test_rows_outside(spark, block):
    draw = random.Random(2)
    taken = [("t", draw.randrange(3), draw.randrange(80)) for _ in range(100)] + [(None, 0, 5)]
    rows = [("t", draw.randrange(4), draw.randrange(-5, 90)) for _ in range(200)] + [(None, 0, 5), (None, 0, 6), ("t", 0, None)]
    ranges = ranges_of(spark.createDataFrame(taken, POINT), KEYS, "offset")
    got = outside(spark.createDataFrame(rows, POINT).repartition(3), ranges, KEYS, "offset")
    have = sets(taken)
    expected = [r for r in rows if r[2] is None or r[2] not in have.get(r[:2], set())]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_nothing(spark):
    none = spark.createDataFrame([], POINT)
    assert ranges_of(none, KEYS, "offset").count() == 0
    some = spark.createDataFrame([("t", 0, 1)], POINT)
    assert outside(some, ranges_of(none, KEYS, "offset"), KEYS, "offset").count() == 1
    assert outside(none, ranges_of(some, KEYS, "offset"), KEYS, "offset").count() == 0
