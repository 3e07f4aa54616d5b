"""Loads that add to a table what has arrived since the last one.

What was read is known by its files, which the checkpoint of the query lists,
and not by a time in the rows; so a row may be late by any number of days.  A
row that was sent before is known by its key, which is looked up only among
the rows of the same days.  What a store holds:

==============  =============================================================
``checkpoint``  the files read so far
``rows``        the rows, by load and day
``newest``      by load: the newest rows of each card (``fraud.newest_rows_of``)
==============  =============================================================

A load writes under its own number and writes the same again if it is run
again.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalbook.plans import fraud

#: Days of a load that the filter on stored days names one by one; a load with
#: more days than these reads the range from the first to the last.
MOST_DAYS = 400


def load(arriving: DataFrame, store: str, day: str, key: str = "txn_id", n: int = fraud.LAST) -> StreamingQuery:
    """Takes in what the stream ``arriving`` of transactions has and stops.

    ``day`` is the column of a row's day.  Rows without a key cannot be told
    apart and are not loaded; of rows that share a key in one load, that with
    the smallest fingerprint is."""
    run = partial(take, store=store, day=day, key=key, n=n)
    return (
        arriving.writeStream.foreachBatch(lambda rows, number: run(rows, number))
        .option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def take(rows: DataFrame, number: int, store: str, day: str, key: str = "txn_id", n: int = fraud.LAST) -> None:
    """Adds the rows of one load that no earlier load has."""
    spark = rows.sparkSession
    one = Window.partitionBy(key).orderBy(F.xxhash64(*rows.columns))
    once = rows.filter(F.col(key).isNotNull()).withColumn("_at", F.row_number().over(one)).filter("_at = 1").drop("_at")
    fresh = once
    if number:
        days = [r[0] for r in once.select(day).distinct().limit(MOST_DAYS + 1).collect()]
        earlier = _rows(spark, store, once.schema, day).filter(F.col("load") < number)
        fresh = once.join(earlier.filter(_within(once, day, days)).select(key), key, "left_anti")
    path = f"{store}/rows/load={number}"
    fresh.write.mode("overwrite").partitionBy(day).parquet(path)
    # From here on only what this load added is read, and one row per place in a card's list.
    written = spark.read.schema(once.schema).parquet(path)
    newest = fraud.newest_rows_of(written, n)
    if number:
        newest = fraud.merged_newest(newest_before(spark, store, number), newest, n)
    newest.write.mode("overwrite").parquet(_newest(store, number))


def _within(rows: DataFrame, day: str, days: list):
    if len(days) > MOST_DAYS:
        first, last, unknown = rows.agg(F.min(day), F.max(day), F.count(F.when(F.col(day).isNull(), 1))).first()
        return F.col(day).between(first, last) | (F.col(day).isNull() & F.lit(bool(unknown)))
    named = F.col(day).isin([d for d in days if d is not None])
    return named | F.col(day).isNull() if None in days else named


def loaded(spark: SparkSession, store: str, schema: T.StructType, day: str) -> DataFrame:
    """All rows so far with the number of their ``load``."""
    return _rows(spark, store, schema, day)


def _rows(spark: SparkSession, store: str, schema: T.StructType, day: str) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("load", T.IntegerType())])
    return spark.read.schema(whole).option("basePath", f"{store}/rows").parquet(f"{store}/rows")


def newest_before(spark: SparkSession, store: str, number: int) -> DataFrame:
    """The newest rows of each card as they stand before load ``number``."""
    return spark.read.schema(fraud.NEWEST).parquet(_newest(store, number - 1))


def _newest(store: str, number: int) -> str:
    return f"{store}/newest/load={number}"
