"""Skewed joins, numbering, newest rows, loads."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from signalbook.operators.dense_index import dense_index
from signalbook.operators.latest import newest_rows, not_loaded, reload_from, upsert
from signalbook.operators.skew import dimension_join, heavy_keys, is_small, range_chunks, salted_join


@pytest.fixture(scope="module")
def facts(spark):
    rows = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 40}", i) for i in range(900)]
    return spark.createDataFrame(rows, "key string, v int").repartition(4)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3), ("unused", 4)], "key string, w int")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("per_task", [1, 10, 100, 10**6])
def test_salted_join_is_a_join(facts, dim, how, per_task):
    plain = Counter(map(tuple, facts.join(dim, "key", how).select("key", "v", "w").collect()))
    salted = salted_join(facts, dim, "key", how, rows_per_task=per_task).select("key", "v", "w")
    assert Counter(map(tuple, salted.collect())) == plain


def test_salts_spread_the_heavy_key(facts, dim):
    joined = salted_join(facts.filter("key = 'hot'"), dim, "key", rows_per_task=30)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_splits" in plan


def test_large_dimension_is_not_broadcast(facts, dim):
    assert is_small(dim, 4) and not is_small(dim, 3)
    plain = Counter(map(tuple, facts.join(dim, "key", "left").select("key", "v", "w").collect()))
    for small in (True, False):
        got = dimension_join(facts, dim, "key", small=small).select("key", "v", "w")
        assert Counter(map(tuple, got.collect())) == plain


def test_heavy_keys_from_a_sample(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"))
    found = heavy_keys(rows, "key", 20_000).collect()
    assert [r.key for r in found] == [0]
    assert found[0]._splits in (3, 4)
    assert heavy_keys(rows, "key", 100_000) is None


def test_chunks_are_runs_of_the_order(facts):
    chunks = range_chunks(facts.filter("key is not null"), "key", ["v"], 600, 50)
    rows = sorted(((r.key, r.v), r.chunk) for r in chunks.collect())
    numbers = [c for _, c in rows]
    assert len(rows) == 600
    assert numbers == sorted(numbers)
    assert max(Counter(numbers).values()) < 150


def test_dense_index_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("n"), F.col("id")).repartition(13)
    got = dense_index(df, [F.desc("n"), F.asc("id")], "at").collect()
    expected = sorted(((i % 7, i) for i in range(1000)), key=lambda r: (-r[0], r[1]))
    assert [(r.n, r.id) for r in sorted(got, key=lambda r: r["at"])] == expected
    assert sorted(r["at"] for r in got) == list(range(1000))


def test_newest_rows_limit_before_the_shuffle(facts):
    newest = newest_rows(facts.filter("key is not null"), "key", ["v"], 3)
    assert Counter(r.key for r in newest.collect())["hot"] == 3
    plan = newest._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below


def test_loads_after_the_first(spark):
    kind = "id int, k string, at int, v string"
    loaded = spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 5, "y")], kind)
    # A new row, one of the boundary, one that is late, and a repeated one.
    more = [(3, "a", 6, "z"), (4, "c", 5, "w"), (5, "d", 4, "v"), (5, "d", 4, "v")]
    source = loaded.unionAll(spark.createDataFrame(more, kind))
    bound = reload_from(loaded, "at", overlap=2)
    assert bound == 3 and reload_from(loaded.limit(0), "at", overlap=2) is None
    fresh = not_loaded(source.filter(source["at"] >= bound), loaded, "id")
    assert sorted(r.id for r in fresh.collect()) == [3, 4, 5]
    fresh, loaded = fresh.drop("id"), loaded.drop("id")
    got = sorted(tuple(r) for r in upsert(loaded, fresh, "k", ["at"]).collect())
    assert got == [("a", 6, "z"), ("b", 5, "y"), ("c", 5, "w"), ("d", 4, "v")]


def test_the_bound_of_a_load_reaches_the_scan(spark, tiny):
    from signalbook.sources import tables

    rows = tables.transactions(tables.events_since(tables.table(spark, tiny, "events"), 1705708800))
    assert "GreaterThanOrEqual(ts" in rows._jdf.queryExecution().executedPlan().toString()
