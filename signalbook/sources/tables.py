"""The logical inputs as views over the benchmark tables of one folder."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbook.functions.clock import epoch_of_ntz, format_dt
from signalbook.operators.skew import salted_join

#: Transactions before this instant are history, the others arrive as a stream.
CUTOFF = "2024-01-21 00:00:00"
TOPIC = "transactions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> F.Column:
    # ``props`` holds this one number; a JSON parse costs four times as much.
    return F.regexp_extract("props", '"k": *([0-9]+)', 1).try_cast("int")


def transactions(events: DataFrame) -> DataFrame:
    """``events`` as card transactions."""
    return events.select(
        F.col("event_id").alias("txn_id"),
        F.col("user_id").cast("string").alias("card_id"),
        F.col("user_id").cast("string").alias("member_id"),
        F.round("value").cast("int").alias("amount"),
        (_k() % 25).cast("string").alias("postcode"),
        F.col("event_type").alias("pos_id"),
        format_dt(F.col("ts")).alias("transaction_dt"),
        epoch_of_ntz("ts").alias("epoch"),
    )


def events_since(events: DataFrame, epoch: int | None) -> DataFrame:
    """Events from an instant on, by a filter on the raw column, which the scan can use."""
    if epoch is None:
        return events
    at = datetime.fromtimestamp(epoch, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return events.filter(F.col("ts") >= F.lit(at).cast("timestamp_ntz"))


def before(events: DataFrame, instant: str) -> DataFrame:
    return events.filter(F.col("ts") < F.lit(instant).cast("timestamp_ntz"))


def history(events: DataFrame) -> DataFrame:
    return transactions(events.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz")))


def arrivals(events: DataFrame) -> DataFrame:
    return transactions(events.filter(F.col("ts") >= F.lit(CUTOFF).cast("timestamp_ntz")))


def records(events: DataFrame, whole_amounts: bool = True) -> DataFrame:
    """``events`` as the JSON records of a topic.  With ``whole_amounts`` off,
    the amounts of ``error`` events keep their decimals and so are bad."""
    amount = F.round("value").cast("int").cast("string")
    if not whole_amounts:
        amount = F.when(F.col("event_type") == "error", F.col("value").cast("string")).otherwise(amount)
    payload = F.struct(
        F.col("user_id").cast("string").alias("card_id"),
        F.col("user_id").cast("string").alias("member_id"),
        amount.alias("amount"),
        (_k() % 25).cast("string").alias("postcode"),
        F.col("event_type").alias("pos_id"),
        format_dt(F.col("ts")).alias("transaction_dt"),
    )
    return events.select(
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.to_json(payload).alias("value"),
    )


def zips(nation: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    return nation.select(
        n.cast("string").alias("zip"),
        (3.0 * n - 36.0).alias("lat"),
        (7.0 * n - 90.0).alias("lon"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("string").alias("state_name"),
        F.lit(None).cast("string").alias("post_id"),
    )


def card_members(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("string").alias("card_id"),
        F.col("c_custkey").cast("string").alias("member_id"),
        F.col("c_nationkey").cast("string").alias("country"),
        F.col("c_mktsegment").alias("city"),
    )


def member_scores(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("string").alias("member_id"), F.col("c_acctbal").alias("score")
    )


def clickstream(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("string").alias("timestamp"),
        _k().cast("string").alias("song_id"),
        F.date_format("ts", "yyyyMMdd").alias("date"),
    )


def song_metadata(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").cast("string").alias("song_id"), F.col("p_brand").alias("artist_id"))


def notification_clicks(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "click").select(
        _k().cast("string").alias("notification_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyyMMdd").alias("date"),
    )


def given_cohorts(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("string").alias("user_id"), F.col("label").alias("cluster"))


def accounts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("account_id"), F.col("lang").alias("gender"), F.col("text").alias("text")
    )


def fixed_predictions(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


#: The day from which recency counts back in the retail queries.
AS_OF = "2001-08-02"


def retail(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order lines with their customer and date."""
    lines = lineitem.select(
        F.col("l_orderkey").alias("InvoiceNo"),
        F.col("l_linenumber").alias("_line"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("UnitPrice"),
    )
    heads = orders.select(
        F.col("o_orderkey").alias("InvoiceNo"),
        F.col("o_custkey").alias("CustomerID"),
        F.date_format("o_orderdate", "MM/dd/yyyy HH:mm").alias("InvoiceDate"),
    )
    return salted_join(lines, heads, "InvoiceNo", "inner").drop("_line")
