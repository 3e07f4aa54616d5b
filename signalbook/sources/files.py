"""Readers of the inputs as files, and loads from a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbook import schemas


def clickstream(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV, every column text."""
    return spark.read.schema(schemas.CLICKSTREAM).csv(path)


def song_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SONG_METADATA).csv(path)


def notification_clicks(spark: SparkSession, path: str) -> DataFrame:
    """Click files; the text ``\\N`` stands for null."""
    return spark.read.schema(schemas.NOTIFICATION_CLICKS).option("nullValue", "\\N").csv(path)


def accounts(spark: SparkSession, path: str) -> DataFrame:
    """Accounts CSV with a header; malformed rows are dropped.

    Columns are those of :data:`schemas.ACCOUNTS`, in the order of the header,
    which may have fewer; one that the schema does not know, or the lack of one
    that is used, is an error."""
    header = spark.read.option("header", True).csv(path).columns
    known = {field.name: field for field in schemas.ACCOUNTS.fields}
    wrong = [n for n in header if n not in known] + [n for n in ("_unit_id", "gender", "text") if n not in header]
    if wrong:
        raise ValueError(f"accounts with unknown or missing columns: {', '.join(wrong)}")
    return (
        spark.read.schema(T.StructType([known[n] for n in header]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "DROPMALFORMED")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
        .select(F.col("_unit_id").alias("account_id"), "gender", "text")
    )


def zips(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ZIPS).csv(path)


def classified_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transactions with a status, as first loaded from CSV."""
    return spark.read.schema(schemas.CLASSIFIED_TRANSACTION).option("header", True).csv(path)


def relational(
    spark: SparkSession, url: str, name: str, column: str, low: int, high: int, partitions: int, **options: str
) -> DataFrame:
    """A database table read in ``partitions`` ranges of a numeric column; a
    read without ranges would go through a single task."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=name, partitionColumn=column, lowerBound=str(low), upperBound=str(high))
        .options(numPartitions=str(partitions), **options)
        .load()
    )


def compact(df: DataFrame, path: str) -> None:
    """Rewrite many small files as few even ones; how many, adaptive execution
    decides by their size."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)
