"""Merging of closed batches changes no row that a reader sees."""

import pytest
from pyspark.sql import functions as F

from signalbook.streaming import compaction, scoring

SCHEMA = "decision_id string, status string, batch int, event_date date"


def batch(spark, store, n, rows=6):
    df = spark.range(rows).select(
        F.concat(F.lit(f"{n}-"), "id").alias("decision_id"), F.lit("GENUINE").alias("status"),
        F.expr(f"date'2024-01-01' + int((id + {n}) % 3)").alias("event_date"),
    )
    df.repartition(2).write.mode("overwrite").partitionBy("event_date").parquet(f"{store}/decisions/batch={n}")


def seen(spark, store):
    return sorted(map(tuple, compaction.decisions(spark, store, SCHEMA).select("decision_id", "status", "batch", "event_date").collect()))


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")


def test_the_same_rows_before_and_after(spark, store, tmp_path):
    sizes = []
    for n in range(9):
        batch(spark, store, n)
        before = seen(spark, store)
        merged = compaction.compact(spark, store, SCHEMA, keep=2)
        assert seen(spark, store) == before and len(before) == 6 * (n + 1)
        sizes.append([high - low + 1 for low, high, _ in merged])
    # Equal segments merge, as in binary counting.
    assert sizes == [[], [], [1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    compaction.sweep(spark, store)
    assert seen(spark, store) == before
    left = sorted(p.name for p in (tmp_path / "store" / "decisions").iterdir() if p.name.startswith("batch="))
    assert left == ["batch=7", "batch=8"]
    assert len(list((tmp_path / "store" / "segments").iterdir())) == len(merged)
    files = [p for p in (tmp_path / "store" / "segments").rglob("part-*.parquet")]
    assert len(files) <= 3 * len(merged)  # a file per day and segment


def test_a_reader_keeps_its_rows_while_a_merge_runs(spark, store):
    for n in range(4):
        batch(spark, store, n)
    reader = compaction.decisions(spark, store, SCHEMA)
    compaction.compact(spark, store, SCHEMA, keep=1)
    assert reader.count() == 24 == compaction.decisions(spark, store, SCHEMA).count()


def test_what_broke_off_does_not_count(spark, store, tmp_path):
    for n in range(3):
        batch(spark, store, n)
    before = seen(spark, store)
    # A merge that wrote its segment and no manifest, and one whose manifest is not complete.
    compaction.decisions(spark, store, SCHEMA).write.partitionBy("event_date").parquet(f"{store}/segments/0-2-broken")
    manifest = spark.createDataFrame([(0, 2, f"{store}/segments/0-2-broken")], compaction.SEGMENTS)
    manifest.write.parquet(f"{store}/manifest/version=2")
    (tmp_path / "store" / "manifest" / "version=2" / "_SUCCESS").unlink()
    assert seen(spark, store) == before
    compaction.compact(spark, store, SCHEMA, keep=0)
    assert seen(spark, store) == before
    compaction.sweep(spark, store)
    assert seen(spark, store) == before


def test_a_last_batch_that_is_run_again_is_not_yet_merged(spark, store):
    for n in range(3):
        batch(spark, store, n)
    compaction.compact(spark, store, SCHEMA, keep=1)
    batch(spark, store, 2, rows=4)  # run again with other rows
    assert len(seen(spark, store)) == 16


def test_an_empty_store_and_the_scorer_s_own_rows(spark, store):
    assert compaction.compact(spark, store, SCHEMA) == [] and compaction.segments(spark, store) == []
    rows = spark.createDataFrame([], scoring.DECISIONS).drop("batch")
    for n in range(3):
        rows.write.mode("overwrite").partitionBy("event_date").parquet(f"{store}/decisions/batch={n}")
    scoring.compact(spark, store, keep=1)
    assert scoring.decisions(spark, store).count() == 0
