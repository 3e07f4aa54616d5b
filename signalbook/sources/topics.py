"""Streams of transaction records: ``topic, partition, offset, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "topic string, partition int, offset bigint, value string"

_OFFSET_BITS = 44  # offsets of one partition stay far below 2**44


def kafka(spark: SparkSession, servers: str, topic: str, max_per_batch: int = 5_000_000, **options: str) -> DataFrame:
    """A Kafka topic from its beginning; the checkpoint of the query, not a
    consumer group, remembers how far it got."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_per_batch)
        .options(**options)
        .load()
        .select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    )


def json_files(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same records from a folder that JSON-lines files arrive in."""
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_batch).json(path)


def identified(records: DataFrame) -> DataFrame:
    """Add ``decision_id``, the same whenever a record is read again, and
    ``txn_id``, which orders records of equal time."""
    return records.withColumns(
        {
            "decision_id": F.sha2(F.concat_ws("|", "topic", "partition", "offset"), 256),
            "txn_id": F.shiftleft(F.col("partition").cast("bigint"), _OFFSET_BITS) + F.col("offset"),
        }
    )
