"""Scoring of arriving transactions with a lookup that moves along.

Each micro-batch is scored like a batch table, so a card with a large part of
its rows is split over tasks there too.  What a store holds:

==================  =========================================================
``checkpoint``      how far the source was read
``decisions``       every verdict, by batch and event date
``segments``        those of closed batches, merged, by event date; ``manifest``
                    says which count
``quarantine``      records that could not be read, by batch
``counts``          records per verdict or fault, by batch
``moves``           by batch: the new place and time of the cards that moved
``seen``            by batch: the offsets taken so far per topic and partition,
                    as merged ranges
``lookup``          by version: the whole lookup as it stood before a batch
==================  =========================================================

Batch ``n`` reads the newest version at or before ``n`` and the moves since.
Everything a batch writes lies under its own number and is overwritten when
the batch runs again, so a lost executor or a restart changes nothing.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from signalbook.operators.intervals import merged, outside, ranges_of
from signalbook.operators.journey_fold import DECISION_FIELDS
from signalbook.plans import fraud
from signalbook.schemas import LOOKUP, MOVES
from signalbook.sources.topics import identified
from signalbook.streaming import compaction

#: A new version of the lookup is written every so many batches.
VERSION_EVERY = 100

SEEN = "topic string, partition int, low bigint, high bigint"
SOURCE = ["topic", "partition"]
STATUSES = ["GENUINE", "FRAUD", "UNKNOWN_CARD", "UNKNOWN_POSTCODE", "UNKNOWN_AMOUNT"]
COUNTS = "status string, count bigint"
CARRY = ["decision_id", *fraud.TRANSACTION]

#: What :func:`decisions` returns, batch and event date from the folders.
DECISIONS = (
    "decision_id string, txn_id bigint, card_id string, member_id string, amount int, postcode string, pos_id string, "
    f"transaction_dt string, epoch bigint, {DECISION_FIELDS}, batch int, event_date date"
)


def start(
    records: DataFrame,
    lookup: DataFrame,
    zips: DataFrame,
    store: str,
    interval: str | None = "1 second",
    version_every: int = VERSION_EVERY,
    rows_per_task: int | None = None,
) -> StreamingQuery:
    """Score the stream ``records`` into ``store``.

    ``lookup`` is used when the store is new; afterwards the store's own
    lookup holds.  ``interval=None`` works off what has arrived and stops.
    """
    lookup.select(*LOOKUP.fieldNames()).write.mode("ignore").parquet(_version(store, 0))
    places = fraud.Places(zips)
    run = partial(
        score_batch, zips=places, store=store, version_every=version_every, rows_per_task=rows_per_task
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        records.writeStream.foreachBatch(lambda batch, number: run(batch, number))
        .option("checkpointLocation", f"{store}/checkpoint")
        .trigger(**trigger)
        .start()
    )


def score_batch(
    records: DataFrame,
    number: int,
    zips: DataFrame | fraud.Places,
    store: str,
    version_every: int = VERSION_EVERY,
    rows_per_task: int | None = None,
) -> None:
    """Score one micro-batch and record what it changed."""
    spark = records.sparkSession
    seen = _seen_before(spark, store, number)
    parsed = fraud.parse_payloads(identified(unseen(records, seen))).persist()
    good = parsed.filter("reason is null").select(*CARRY)
    lookup = fraud.cards_in(good, lookup_before(spark, store, number, version_every))
    scored = fraud.score_transactions(good, lookup, zips, CARRY, rows_per_task)

    # What is written is counted on its way.
    written = f"{store}/decisions/batch={number}"
    date = F.to_date(F.substring("transaction_dt", 1, 10), "dd-MM-yyyy")
    verdicts, dated = _counting(scored.withColumn("event_date", date), "status", STATUSES)
    dated.write.mode("overwrite").partitionBy("event_date").parquet(written)
    faults, refused = _counting(fraud.quarantined(parsed), "reason", fraud.FAULTS)
    refused.write.mode("overwrite").parquet(f"{store}/quarantine/batch={number}")
    counts = [(name, n) for name, n in {**verdicts.get, **faults.get}.items() if n]
    spark.createDataFrame(counts, COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{store}/counts/batch={number}")

    # The verdicts are read back: moves then rest on what was stored.
    stored = spark.read.schema(scored.schema).parquet(written)
    moves = fraud.closing_places(stored)
    moves.write.mode("overwrite").parquet(_moves(store, number))
    taken = merged(seen.unionByName(ranges_of(records, SOURCE, "offset")), SOURCE)
    taken.write.mode("overwrite").parquet(_seen(store, number))
    parsed.unpersist()


def _counting(df: DataFrame, column: str, values: list[str]) -> tuple[Observation, DataFrame]:
    """``df``, and how many rows it had per value once it has been written."""
    seen = Observation()
    counts = [F.count(F.when(F.col(column) == v, 1)).alias(v) for v in values]
    return seen, df.observe(seen, *counts)


def unseen(records: DataFrame, seen: DataFrame) -> DataFrame:
    """Records whose offset no earlier batch has taken, in whatever order
    offsets come; each once, of those that share an offset in this batch that
    with the smaller value."""
    fresh = outside(records, seen, SOURCE, "offset")
    return fresh.groupBy(*SOURCE, "offset").agg(F.min("value").alias("value"))


def _seen_before(spark: SparkSession, store: str, number: int) -> DataFrame:
    if number == 0:
        return spark.createDataFrame([], SEEN)
    return spark.read.schema(SEEN).parquet(_seen(store, number - 1))


def lookup_before(spark: SparkSession, store: str, number: int, version_every: int = VERSION_EVERY) -> DataFrame:
    """The lookup as it stands before batch ``number``."""
    version = number - number % version_every
    if number and version == number:
        whole = _replay(spark, store, version - version_every, number)
        whole.write.mode("overwrite").parquet(_version(store, version))
    return _replay(spark, store, version, number)


def _replay(spark: SparkSession, store: str, version: int, number: int) -> DataFrame:
    base = spark.read.schema(LOOKUP).parquet(_version(store, version))
    if version == number:
        return base
    schema = MOVES.simpleString()[len("struct<") : -1].replace(":", " ") + ", batch int"
    moves = (
        spark.read.schema(schema)
        .option("basePath", f"{store}/moves")
        .parquet(*[_moves(store, n) for n in range(version, number)])
    )
    last = F.max_by(F.struct(*[n for n in MOVES.fieldNames() if n != "card_id"]), "batch")
    return fraud.move_lookup(base, moves.groupBy("card_id").agg(last.alias("_m")).select("card_id", "_m.*"))


def decisions(spark: SparkSession, store: str) -> DataFrame:
    """All verdicts so far, from segments where batches have been merged."""
    return compaction.decisions(spark, store, DECISIONS)


def compact(spark: SparkSession, store: str, keep: int = 2) -> None:
    """Merges the small files of closed batches; may run beside the stream."""
    compaction.compact(spark, store, DECISIONS, keep)


def _version(store: str, number: int) -> str:
    return f"{store}/lookup/version={number}"


def _seen(store: str, number: int) -> str:
    return f"{store}/seen/batch={number}"


def _moves(store: str, number: int) -> str:
    return f"{store}/moves/batch={number}"
