"""The stream with operator state gives what the batch gives."""

import pytest
from pyspark.sql import functions as F

from signalbook.plans import fraud
from signalbook.queries import DECISION, _lookup, _zips
from signalbook.sources import tables as t
from signalbook.sources import topics
from signalbook.streaming import keyed


@pytest.fixture(scope="module")
def inputs(spark, tiny):
    events = t.table(spark, tiny, "events")
    arriving = events.filter(F.col("ts") >= F.lit(t.CUTOFF).cast("timestamp_ntz"))
    batch = fraud.score_transactions(t.arrivals(events), _lookup(spark, tiny), _zips(spark, tiny))
    expected = {r.txn_id: tuple(r[c] for c in DECISION) for r in batch.collect()}
    records = t.records(arriving.orderBy("ts", "event_id")).collect()
    return records, expected, _lookup(spark, tiny), _zips(spark, tiny)


def arrive(spark, source, records, first, parts):
    size = -(-len(records) // parts)
    for n in range(parts):
        part = spark.createDataFrame(records[n * size : (n + 1) * size][::-1], topics.RECORD)  # unsorted inside
        part.coalesce(1).write.json(f"{source}/{first + n:03d}")


def run(spark, source, inputs, store, lookup=None):
    stream = topics.json_files(spark, f"{source}/*", files_per_batch=1)
    query = keyed.start(stream, inputs[2] if lookup is None else lookup, inputs[3], store, interval=None)
    query.awaitTermination()
    return query


def stored(spark, store):
    rows = keyed.decisions(spark, store).select("decision_id", *DECISION).collect()
    assert len({r.decision_id for r in rows}) == len(rows)
    return {r.txn_id: tuple(r[c] for c in DECISION) for r in rows}


def test_four_files_and_a_restart(spark, inputs, tmp_path):
    records, expected, lookup, _ = inputs
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    half = len(records) // 2
    arrive(spark, source, records[:half], 0, 2)
    run(spark, source, inputs, store)
    part = stored(spark, store)
    assert len(part) == half and part.items() <= expected.items()
    arrive(spark, source, records[half:], 2, 2)
    # The state holds from here on; another lookup is not looked at.
    run(spark, source, inputs, store, lookup.withColumn("ucl", F.lit(-1.0)))
    assert stored(spark, store) == expected
    run(spark, source, inputs, store)  # nothing new
    assert stored(spark, store) == expected


def test_the_provider_of_the_session_is_left_as_it_was(spark, inputs, tmp_path):
    before = spark.conf.get(keyed._PROVIDER)
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    arrive(spark, source, inputs[0][:3], 0, 1)
    query = run(spark, source, inputs, store)
    assert spark.conf.get(keyed._PROVIDER) == before
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] >= inputs[2].count()  # the cards of the lookup, known before their first record


def test_unknown_cards_places_and_half_known_rows(spark, tmp_path):
    zips = spark.createDataFrame([("1", 0.0, 0.0), ("2", 1.0, 1.0)], "zip string, lat double, lon double")
    lookup = spark.createDataFrame(
        [("a", 100.0, 500, "1", "01-01-2024 00:00:00", 1704067200), ("b", None, 500, "1", "01-01-2024 00:00:00", 1704067200),
         ("c", 100.0, 500, "9", "01-01-2024 00:00:00", 1704067200)],
        "card_id string, ucl double, score int, postcode string, transaction_dt string, epoch bigint",
    )
    value = '{{"card_id": "{}", "member_id": "m", "amount": "{}", "postcode": "{}", "pos_id": "p", "transaction_dt": "{}"}}'
    rows = [
        ("a", "50", "2", "01-01-2024 02:00:00"), ("a", "500", "1", "01-01-2024 03:00:00"), ("a", "5", "7", "01-01-2024 04:00:00"),
        ("a", "5", "1", "01-01-2024 02:00:01"), ("b", "5", "1", "02-01-2024 02:00:00"), ("c", "5", "1", "02-01-2024 02:00:00"),
        ("z", "5", "1", "02-01-2024 02:00:00"),
    ]
    records = [("t", 0, i, value.format(*r)) for i, r in enumerate(rows)] + [("t", 0, 99, "{")]
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    arrive(spark, source, records, 0, 1)
    stream = topics.json_files(spark, f"{source}/*")
    keyed.start(stream, lookup, zips, store, interval=None).awaitTermination()
    keyed.start_quarantine(stream, store, interval=None).awaitTermination()
    got = {r.txn_id: r.status for r in keyed.decisions(spark, store).collect()}
    assert got == {0: "GENUINE", 1: "FRAUD", 2: "UNKNOWN_POSTCODE", 3: "FRAUD", 4: "UNKNOWN_CARD", 5: "UNKNOWN_POSTCODE", 6: "UNKNOWN_CARD"}
    as_batch = spark.createDataFrame(records, topics.RECORD)
    good = fraud.accepted(fraud.parse_payloads(topics.identified(as_batch)))
    batch = {r.txn_id: r.status for r in fraud.score_transactions(good, lookup, zips).collect()}
    assert got == batch
    assert [r.reason for r in spark.read.parquet(f"{store}/quarantine").collect()] == ["MALFORMED_JSON"]


def test_many_cards_are_walked_in_few_calls(spark, inputs, tmp_path, monkeypatch):
    """A call for each card cost more than its rows; a bucket's cards keep their own state."""
    calls = spark.sparkContext.accumulator(0)
    walked = keyed.CardState.handleInputRows

    def counted(self, key, rows, timerValues):
        calls.add(1)
        return walked(self, key, rows, timerValues)

    monkeypatch.setattr(keyed, "BUCKETS", 2)
    monkeypatch.setattr(keyed.CardState, "handleInputRows", counted)
    records, expected, _, _ = inputs
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    arrive(spark, source, records, 0, 2)
    run(spark, source, inputs, store)
    assert stored(spark, store) == expected
    assert calls.value == 2 * 2 < len({r[2] for r in expected.values()})
