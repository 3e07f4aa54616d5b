"""Verdicts of closed batches in few files, while the stream goes on.

A scorer writes a folder per batch, so a day's verdicts end up in as many
files as there were batches.  :func:`compact` merges those of closed batches into
a segment, laid out by day, and then publishes a manifest that names the
segments.  A manifest is a folder that counts once its writer has marked it
as complete, and readers take the newest one; they see all rows once, before,
while and after a merge, and after one that broke off.  Segments that cover
equally many batches are merged in turn, so a row is rewritten about as often as the
number of batches doubles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENTS = "low int, high int, path string"


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def numbered(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers of the complete folders ``key=number`` in a folder, rising."""
    files, place = _files(spark, path)
    if not files.exists(place):
        return []
    out = []
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith(f"{key}=") and files.exists(_files(spark, f"{path}/{name}/_SUCCESS")[1]):
            out.append(int(name.split("=")[1]))
    return sorted(out)


def segments(spark: SparkSession, store: str) -> list[tuple[int, int, str]]:
    """First and last batch and folder of each segment of the newest manifest."""
    versions = numbered(spark, f"{store}/manifest", "version")
    if not versions:
        return []
    rows = spark.read.schema(SEGMENTS).parquet(f"{store}/manifest/version={versions[-1]}").orderBy("low").collect()
    return [tuple(r) for r in rows]


def decisions(spark: SparkSession, store: str, schema: str) -> DataFrame:
    """All verdicts so far: the segments and the batches after them."""
    merged = segments(spark, store)
    rows = spark.read.schema(schema).option("basePath", f"{store}/decisions").parquet(f"{store}/decisions")
    if not merged:
        return rows
    out = rows.filter(F.col("batch") > merged[-1][1])
    for _, _, path in merged:
        out = out.unionByName(spark.read.schema(schema).parquet(path))
    return out


def compact(spark: SparkSession, store: str, schema: str, keep: int = 2) -> list[tuple[int, int, str]]:
    """Merges the verdicts of all but the last ``keep`` batches, which may be
    run again, into segments; returns the segments now in force."""
    merged = segments(spark, store)
    done = merged[-1][1] if merged else -1
    closed = [n for n in numbered(spark, f"{store}/decisions", "batch")[: -keep or None] if n > done]
    if not closed:
        return merged
    rows = spark.read.schema(schema).option("basePath", f"{store}/decisions")
    rows = rows.parquet(*[f"{store}/decisions/batch={n}" for n in closed])
    low, high, size = closed[0], closed[-1], len(closed)
    while merged and merged[-1][1] - merged[-1][0] + 1 <= size:
        low, _, path = merged.pop()
        size = high - low + 1
        rows = rows.unionByName(spark.read.schema(schema).parquet(path))
    path = f"{store}/segments/{low}-{high}-{uuid.uuid4().hex}"
    # As many files a day as its size asks for.
    rows.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(path)
    merged.append((low, high, path))
    spark.createDataFrame(merged, SEGMENTS).coalesce(1).write.mode("overwrite").parquet(f"{store}/manifest/version={high}")
    return merged


def sweep(spark: SparkSession, store: str) -> None:
    """Deletes what the newest manifest has made needless: batches that lie in
    a segment, segments and manifests that were replaced.  For when no reader
    is at work with an older manifest."""
    merged = segments(spark, store)
    if not merged:
        return
    kept = {path.rsplit("/", 1)[-1] for _, _, path in merged}
    files, place = _files(spark, f"{store}/segments")
    for status in files.listStatus(place):
        if status.getPath().getName() not in kept:
            files.delete(status.getPath(), True)
    for n in numbered(spark, f"{store}/decisions", "batch"):
        if n <= merged[-1][1]:
            files.delete(_files(spark, f"{store}/decisions/batch={n}")[1], True)
    for n in numbered(spark, f"{store}/manifest", "version")[:-1]:
        files.delete(_files(spark, f"{store}/manifest/version={n}")[1], True)
