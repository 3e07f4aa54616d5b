"""The stream gives what the batch gives, across batches and restarts."""

import pytest
from pyspark.sql import functions as F

from signalbook.plans import fraud
from signalbook.queries import DECISION, _lookup, _zips
from signalbook.sources import tables as t
from signalbook.sources import topics
from signalbook.streaming import scoring


@pytest.fixture(scope="module")
def inputs(spark, tiny):
    events = t.table(spark, tiny, "events")
    arriving = events.filter(F.col("ts") >= F.lit(t.CUTOFF).cast("timestamp_ntz"))
    batch = fraud.score_transactions(t.arrivals(events), _lookup(spark, tiny), _zips(spark, tiny))
    expected = {r.txn_id: tuple(r[c] for c in DECISION) for r in batch.collect()}
    records = t.records(arriving).orderBy("offset").collect()
    return records, expected, _lookup(spark, tiny), _zips(spark, tiny)


def drop_files(spark, records, folder, first, parts):
    """Write ``records`` as numbered JSON files, in time order."""
    size = -(-len(records) // parts)
    for n in range(parts):
        part = spark.createDataFrame(records[n * size : (n + 1) * size], topics.RECORD)
        part.coalesce(1).write.mode("append").json(f"{folder}/{first + n:03d}")


def run(spark, source, inputs, store, **options):
    _records, _expected, lookup, zips = inputs
    stream = topics.json_files(spark, f"{source}/*", files_per_batch=1)
    query = scoring.start(stream, lookup, zips, store, interval=None, **options)
    query.awaitTermination()
    return query


def stored(spark, store):
    rows = scoring.decisions(spark, store).select("decision_id", *DECISION).collect()
    assert len({r.decision_id for r in rows}) == len(rows)
    return {r.txn_id: tuple(r[c] for c in DECISION) for r in rows}


def test_restart_in_the_middle(spark, inputs, tmp_path):
    records, expected, _, _ = inputs
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    half = len(records) // 2
    drop_files(spark, records[:half], source, 0, 2)
    run(spark, source, inputs, store, version_every=2)
    drop_files(spark, records[half:], source, 2, 3)
    run(spark, source, inputs, store, version_every=2, rows_per_task=7)
    assert stored(spark, store) == expected
    assert {p.name for p in (tmp_path / "store" / "lookup").iterdir()} == {"version=0", "version=2", "version=4"}

    counts = spark.read.parquet(f"{store}/counts").groupBy("status").agg(F.sum("count").alias("n")).collect()
    assert sum(r.n for r in counts) == len(records)

    # The lookup after all batches is where the batch leaves each card.
    final = {r.card_id: (r.postcode, r.epoch) for r in scoring.lookup_before(spark, store, 5, 2).collect()}
    genuine = [v for v in expected.values() if v[-1] == "GENUINE"]
    for card in {v[1] for v in genuine}:
        last = max((v for v in genuine if v[1] == card), key=lambda v: (v[7], v[0]))
        assert final[card] == (last[4], last[7])


def test_batch_run_again_changes_nothing(spark, inputs, tmp_path):
    records, _, lookup, zips = inputs
    store = str(tmp_path / "store")
    lookup.write.parquet(f"{store}/lookup/version=0")
    third = len(records) // 3
    for n in (0, 1, 1, 0, 1, 2, 2):  # replays of a batch, and of the one before it
        part = spark.createDataFrame(records[n * third : (n + 1) * third], topics.RECORD)
        scoring.score_batch(part, n, zips, store, version_every=2)
    got = stored(spark, store)
    assert len(got) == 3 * third
    assert got.items() <= inputs[1].items()


def test_bad_records_and_empty_batch(spark, inputs, tmp_path):
    records, expected, lookup, zips = inputs
    store = str(tmp_path / "store")
    lookup.write.parquet(f"{store}/lookup/version=0")
    bad = [("transactions", 1, 0, "{"), ("transactions", 1, 1, '{"card_id": "1"}')]
    scoring.score_batch(spark.createDataFrame(bad, topics.RECORD), 0, zips, store)
    scoring.score_batch(spark.createDataFrame([], topics.RECORD), 1, zips, store)
    whole = spark.createDataFrame(records, topics.RECORD)
    scoring.score_batch(whole, 2, zips, store)
    assert stored(spark, store) == expected
    faults = spark.read.parquet(f"{store}/quarantine").orderBy("txn_id").collect()
    assert [r.reason for r in faults] == ["MALFORMED_JSON", "MISSING_FIELD"]


def test_ids_depend_on_the_place_in_the_topic(spark):
    rows = spark.createDataFrame([("t", 0, 5, "x"), ("t", 1, 5, "x"), ("t", 1, 6, "x")], topics.RECORD)
    once = topics.identified(rows).collect()
    again = topics.identified(rows.repartition(3)).collect()
    assert {r.decision_id for r in once} == {r.decision_id for r in again}
    assert len({r.decision_id for r in once}) == 3
    assert len({r.txn_id for r in once}) == 3


def test_replayed_records_are_stored_once(spark, inputs, tmp_path):
    records, expected, _, _ = inputs
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    half = len(records) // 2
    drop_files(spark, records[:half] + records[:half], source, 0, 1)  # twice in a batch
    drop_files(spark, records[: half // 2], source, 1, 1)  # and again in the next
    drop_files(spark, records[half // 2 :], source, 2, 1)
    run(spark, source, inputs, store)
    assert stored(spark, store) == expected


def test_decisions_of_a_store_with_bad_records_only(spark, inputs, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    bad = [tuple(r)[:3] + ("no json",) for r in inputs[0][:5]]
    drop_files(spark, bad, source, 0, 1)
    run(spark, source, inputs, store)
    assert scoring.decisions(spark, store).count() == 0


def test_offsets_in_any_order_are_taken_once(spark, inputs, tmp_path):
    """A record that comes after higher offsets is no replay."""
    records, expected, lookup, zips = inputs
    store = str(tmp_path / "store")
    lookup.write.parquet(f"{store}/lookup/version=0")
    by_offset = dict(enumerate(records[:6]))
    for number, n in enumerate((5, 3, 4, 5)):
        one = spark.createDataFrame([by_offset[n]], topics.RECORD)
        scoring.score_batch(one, number, zips, store)
    assert set(stored(spark, store)) == {by_offset[n].offset for n in (3, 4, 5)}
    taken = spark.read.parquet(f"{store}/seen/batch=3")
    gaps = sorted(by_offset[n].offset for n in (3, 4, 5))
    assert taken.count() == 1 + sum(b - a > 1 for a, b in zip(gaps, gaps[1:], strict=False))


def test_files_out_of_offset_order(spark, inputs, tmp_path):
    """All records get a verdict although files bring high offsets first."""
    records, expected, _, _ = inputs
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    third = len(records) // 3
    for n, part in enumerate((records[2 * third :], records[:third], records[third : 2 * third], records[:third])):
        drop_files(spark, part, source, n, 1)
        run(spark, source, inputs, store)
    assert set(stored(spark, store)) == set(expected)


def test_of_two_records_with_one_offset_the_smaller_value_stays(spark):
    rows = [("t", 0, 1, "b"), ("t", 0, 1, "a"), ("t", 0, 2, "c")]
    none = spark.createDataFrame([], scoring.SEEN)
    for order in (rows, rows[::-1]):
        got = scoring.unseen(spark.createDataFrame(order, topics.RECORD), none)
        assert sorted(map(tuple, got.collect())) == [("t", 0, 1, "a"), ("t", 0, 2, "c")]


def test_counts_come_with_the_pass(spark, inputs, tmp_path):
    """The counts are those of what was stored, and no job reads it for them."""
    records, _, lookup, zips = inputs
    store = str(tmp_path / "store")
    lookup.write.parquet(f"{store}/lookup/version=0")
    bad = [("transactions", 1, 0, "{"), ("transactions", 1, 1, "{")]
    places = fraud.Places(zips)
    spark.sparkContext.setJobGroup("batch", "ten records")
    scoring.score_batch(spark.createDataFrame(records[:8] + bad, topics.RECORD), 0, places, store)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("batch"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    counts = {r.status: r["count"] for r in spark.read.parquet(f"{store}/counts").collect()}
    got = scoring.decisions(spark, store).groupBy("status").count().collect()
    assert counts == {**{r.status: r["count"] for r in got}, "MALFORMED_JSON": 2}
    assert jobs <= MOST_JOBS


#: Jobs of a batch, with those by which adaptive execution computes one stage each.
MOST_JOBS = 30
