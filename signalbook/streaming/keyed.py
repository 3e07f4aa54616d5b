"""Scoring of arriving transactions with each card's place in operator state.

The lookup enters once, as the initial state of its cards.  From then on a
card's limit, score and last genuine place live in the state store (RocksDB,
checkpointed by the query), an entry per card, and a batch touches only the
cards it has rows of: nothing is read back, replayed or rewritten.  The verdicts
go to Spark's file sink, whose log makes every batch count once.

All rows that a bucket of cards has in one micro-batch are sorted and walked in
one task, so the source must bound a batch (``maxOffsetsPerTrigger``,
``maxFilesPerTrigger``).
:mod:`signalbook.streaming.scoring` is for topics in which one card may fill
most of a batch; it cuts such a card into chunks.  Offsets are trusted to the
source's checkpoint here: a record sent twice is two transactions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from signalbook.operators.journey_fold import DECIDE_INPUT, DECISION_FIELDS, START, TRANSACTION, decide
from signalbook.plans import fraud
from signalbook.sources.topics import identified

# Executors get the processor by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CARRY = ["decision_id", *fraud.TRANSACTION]
ORDER = fraud.ORDER
KNOWN = "ucl double, score double, lat double, lon double, epoch bigint"
_TRANSACTION = (
    "decision_id string, txn_id bigint, card_id string, member_id string, amount int, postcode string, pos_id string, "
    "transaction_dt string, epoch bigint"
)
#: What :func:`decisions` returns.
DECISIONS = f"{_TRANSACTION}, {DECISION_FIELDS}"
#: Cards are dealt into so many buckets, and a bucket's rows of a batch are
#: walked together: a call for each card would cost more than its few rows.
BUCKETS = 512
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CardState(StatefulProcessor):
    """The fold over the cards of one bucket, batch after batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "card_id string", KNOWN)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        rows = initialState.drop_duplicates("card_id")
        floats = [rows[c].astype("float64").tolist() for c in ("ucl", "score", "lat", "lon")]
        for card, *state, epoch in zip(rows["card_id"], *floats, rows["epoch"].tolist(), strict=True):
            self.known.updateValue((card,), (*state, int(epoch)))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True).sort_values(["card_id", *ORDER], ignore_index=True)
        known = {card: self.known.getValue((card,)) for card in arrived["card_id"].unique().tolist()}
        known = {card: tuple(state) for card, state in known.items() if state is not None}
        start = pd.DataFrame([(c, *s) for c, s in known.items()], columns=["card_id", "ucl", "score", "lat", "lon", "epoch"])
        walk = pd.concat([start.assign(kind=START), arrived.assign(kind=TRANSACTION)], ignore_index=True).assign(chunk=0)
        # Stable: a card's start comes first, then its transactions in their order.
        walk = walk.sort_values("card_id", kind="stable", ignore_index=True)
        walk = walk.reindex(columns=[*dict.fromkeys([*CARRY, *DECIDE_INPUT])])
        batch = pa.RecordBatch.from_pandas(walk, schema=_WALK, preserve_index=False)
        for decided in decide(CARRY)(iter([batch])):
            verdicts = decided.to_pandas()
            last = arrived[verdicts["status"] == "GENUINE"].drop_duplicates("card_id", keep="last")
            places = [last[c].tolist() for c in ("lat", "lon", "epoch")]
            for card, lat, lon, epoch in zip(last["card_id"], *places, strict=True):
                self.known.updateValue((card,), (*known[card][:2], float(lat), float(lon), int(epoch)))
            yield verdicts

    def close(self) -> None:
        pass


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
_KINDS = dict(f.split() for f in f"{_TRANSACTION}, chunk int, kind int, lat double, lon double, ucl double, score double".split(", "))
_WALK = pa.schema([(n, _ARROW[_KINDS[n]]) for n in dict.fromkeys([*CARRY, *DECIDE_INPUT])])


@contextmanager
def _rocksdb(spark: SparkSession):
    """A query keeps the state store that is set when it starts."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def scored(records: DataFrame, lookup: DataFrame, zips: DataFrame | fraud.Places) -> DataFrame:
    """The stream ``records`` as verdicts; ``lookup`` is each card's state
    before its first record and is not read again."""
    places = fraud.Places.of(zips)
    good = fraud.parse_payloads(identified(records)).filter("reason is null").select(*CARRY)
    known = places.locate(lookup).select("card_id", "ucl", lookup["score"].cast("double").alias("score"), "lat", "lon", "epoch")
    bucket = F.pmod(F.xxhash64("card_id"), F.lit(BUCKETS)).alias("bucket")
    return (
        places.locate(good).select(*CARRY, "lat", "lon", bucket)
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=CardState(),
            outputStructType=T._parse_datatype_string(DECISIONS),
            outputMode="Append",
            timeMode="None",
            initialState=known.filter("card_id is not null").select("*", bucket).groupBy("bucket"),
        )
    )


def start(
    records: DataFrame,
    lookup: DataFrame,
    zips: DataFrame | fraud.Places,
    store: str,
    interval: str | None = "1 second",
) -> StreamingQuery:
    """Score the stream ``records`` into ``store``; ``interval=None`` works off
    what has arrived and stops.  Started again with the same store, the query
    goes on from its checkpoint, state included."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    with _rocksdb(records.sparkSession):
        return (
            scored(records, lookup, zips)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{store}/checkpoint")
            .outputMode("append")
            .trigger(**trigger)
            .start(f"{store}/decisions")
        )


def start_quarantine(records: DataFrame, store: str, interval: str | None = "1 second") -> StreamingQuery:
    """The records that cannot be read, with their fault, beside the verdicts."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    refused = fraud.quarantined(fraud.parse_payloads(identified(records)))
    return (
        refused.writeStream.format("parquet")
        .option("checkpointLocation", f"{store}/checkpoint_quarantine")
        .trigger(**trigger)
        .start(f"{store}/quarantine")
    )


def decisions(spark: SparkSession, store: str) -> DataFrame:
    """All verdicts so far."""
    return spark.read.schema(DECISIONS).parquet(f"{store}/decisions")
