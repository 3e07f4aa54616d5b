"""Every query with a SQL twin gives DuckDB's rows on the same files."""

import duckdb
import pytest

import __spark_entry__ as driver
from signalbook.operators import skew

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{tiny}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_same_rows_as_sql(spark, duck, tiny, name):
    df = driver.queries()[name](spark, tiny)
    answer = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, answer.fetchall())


SPLIT = "zip_distance rolling10 fraud_rules fraud_score stream_fraud cohort_clicks click_artist rfm".split()


@pytest.mark.parametrize("name", SPLIT)
def test_same_rows_with_every_key_heavy(spark, duck, tiny, name, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 12)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 3)
    test_same_rows_as_sql(spark, duck, tiny, name)


def test_entry_has_every_arrival(spark, tiny):
    scored = driver.entry(spark)
    assert scored.count() == 302
    assert {r.status for r in scored.select("status").distinct().collect()} <= {"GENUINE", "FRAUD"}


def test_sql_only_for_known_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())
