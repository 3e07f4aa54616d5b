"""Loads of what has arrived, whatever its age."""

import random

import pytest

from signalbook.plans import fraud
from signalbook.streaming import loading

ROW = (
    "txn_id bigint, card_id string, member_id string, amount int, postcode string, pos_id string, "
    "transaction_dt string, epoch bigint, event_date date"
)


def row(n, day, amount=None):
    import datetime

    at = 1_700_000_000 + 86_400 * day + n
    when = datetime.datetime.fromtimestamp(at, datetime.timezone.utc)
    card = "hot" if n % 3 == 0 else f"c{n % 5}"
    return (n, card, card, amount or n % 50, str(n % 4), "p", when.strftime("%d-%m-%Y %H:%M:%S"), at, when.date())


def newest(rows, n):
    out = {}
    for r in sorted(rows, key=lambda r: (r[7], r[0])):
        out.setdefault(r[1], []).append((r[1], r[3], r[4], r[6], r[7], r[0]))
    return sorted(x for kept in out.values() for x in kept[-n:])


def stored(spark, store, schema):
    got = loading.loaded(spark, store, schema, "event_date").collect()
    return {r.txn_id: r.load for r in got}, got


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "store")


def arrive(spark, source, store, rows, number):
    df = spark.createDataFrame(rows, ROW).repartition(3)
    df.write.parquet(f"{source}/{number}")
    stream = spark.readStream.schema(df.schema).parquet(f"{source}/*")
    loading.load(stream, store, "event_date", n=4).awaitTermination()
    return df.schema


def test_rows_of_any_age_are_loaded_once(spark, place):
    draw = random.Random(4)
    days = {n: draw.randrange(40) for n in range(120)}
    first = [row(n, days[n]) for n in range(0, 60)]
    # Up to forty days late, some sent before, some twice.
    second = [row(n, days[n]) for n in range(40, 100)] + [row(70, days[70])]
    third = [row(n, days[n]) for n in range(0, 120)]
    for number, rows in enumerate([first, second, third]):
        schema = arrive(spark, *place, rows, number)
    loads, got = stored(spark, place[1], schema)
    assert len(got) == 120
    assert loads == {n: 0 if n < 60 else 1 if n < 100 else 2 for n in range(120)}
    # The newest rows, kept along, are those of the union.
    kept = loading.newest_before(spark, place[1], 3)
    assert sorted(map(tuple, kept.collect())) == newest(third, 4)


def test_a_load_run_again_changes_nothing(spark, place):
    _, store = place
    parts = [[row(n, n % 30) for n in range(a, b)] for a, b in ((0, 30), (20, 50), (45, 60))]
    for number in (0, 1, 1, 0, 1, 2, 2):
        df = spark.createDataFrame(parts[number], ROW)
        loading.take(df, number, store, "event_date", n=4)
    loads, got = stored(spark, store, df.schema)
    assert len(got) == 60 and loads[29] == 0 and loads[30] == 1 and loads[59] == 2
    assert sorted(map(tuple, loading.newest_before(spark, store, 3).collect())) == newest([row(n, n % 30) for n in range(60)], 4)


def test_no_day_no_key_no_rows_and_many_days(spark, place, monkeypatch):
    _, store = place
    nameless = (None, *row(1, 1)[1:])
    dateless = (*row(500, 1)[:-1], None)
    empty = spark.createDataFrame([], ROW)
    loading.take(empty, 0, store, "event_date")
    loading.take(spark.createDataFrame([row(1, 1), nameless, dateless], ROW), 1, store, "event_date")
    loading.take(empty, 2, store, "event_date")
    monkeypatch.setattr(loading, "MOST_DAYS", 2)
    again = [row(1, 1), dateless, row(2, 5), row(3, 9), row(4, 12)]
    loading.take(spark.createDataFrame(again, ROW), 3, store, "event_date")
    loads, got = stored(spark, store, empty.schema)
    assert len(got) == 5 and loads == {1: 1, 500: 1, 2: 3, 3: 3, 4: 3}


def test_of_rows_with_one_key_the_same_one_stays(spark, place):
    rows = [row(1, 1, amount=a) for a in (5, 6, 7)]
    kept = set()
    for number, order in enumerate([rows, rows[::-1], rows[1:] + rows[:1]]):
        store = f"{place[1]}-{number}"
        df = spark.createDataFrame(order, ROW).repartition(2)
        loading.take(df, 0, store, "event_date")
        kept |= {r.amount for r in stored(spark, store, df.schema)[1]}
    assert len(kept) == 1


def test_only_days_of_the_load_are_read(spark, place):
    """The scan of earlier rows is pruned to the days that a load brings."""
    _, store = place
    df = spark.createDataFrame([row(n, n) for n in range(20)], ROW)
    loading.take(df, 0, store, "event_date")
    days = [r[0] for r in df.filter("txn_id = 3").select("event_date").collect()]
    earlier = loading.loaded(spark, store, df.schema, "event_date").filter(loading._within(df, "event_date", days))
    plan = earlier._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan.split("PartitionFilters", 1)[1].split("]")[0]
    assert [r.txn_id for r in earlier.collect()] == [3]


def test_newest_rows_merge_in_any_order(spark):
    rows = [row(n, n % 7) for n in range(90)]
    schema = ROW
    parts = [spark.createDataFrame(rows[a:b], schema) for a, b in ((0, 10), (10, 70), (70, 90))]
    tops = [fraud.newest_rows_of(p, 6) for p in parts]
    for order in ((0, 1, 2), (2, 0, 1)):
        merged = tops[order[0]]
        for i in order[1:]:
            merged = fraud.merged_newest(merged, tops[i], 6)
        assert sorted(map(tuple, merged.collect())) == newest(rows, 6)
    whole = fraud.last_n_stats(spark.createDataFrame(rows, schema), 6)
    assert sorted(map(tuple, fraud.last_n_stats(merged, 6).collect())) == sorted(map(tuple, whole.collect()))
