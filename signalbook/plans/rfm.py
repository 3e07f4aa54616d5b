"""Recency, frequency and monetary value of customers, and their segments."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
INVOICE_DATE_FORMAT = "MM/dd/yyyy HH:mm"  # fixed value


def money(column: str) -> Column:
    """Exact, so no order of adding up shows in a sum."""
    return F.col(column).cast("decimal(18,4)")


def rfm(retail: DataFrame, as_of: str) -> DataFrame:
    """Per customer: days since the newest invoice, number of invoices, and
    money spent, in one pass over the order lines.

    Lines are first summed per invoice (on the map side where they can be),
    so a customer or an invoice of any size is added up in pieces.
    """
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date("InvoiceDate", INVOICE_DATE_FORMAT))
    invoices = (
        retail.na.drop("any")
        .groupBy("CustomerID", "InvoiceNo")
        .agg(F.sum(money("Quantity") * money("UnitPrice")).alias("_spent"), F.min(days).alias("_days"))
    )
    return invoices.groupBy("CustomerID").agg(
        F.min("_days").alias("Recency"),
        F.count(F.lit(1)).alias("Frequency"),
        F.round(F.sum("_spent"), 2).cast("double").alias("Monetary"),
    )


class Segments:
    """Customers in ``k`` clusters by their three values."""

    def __init__(self, values: DataFrame, k: int = 3, seed: int = SEED):
        inputs = ["Monetary", "Frequency", "Recency"]
        points = VectorAssembler(inputCols=inputs, outputCol="features").transform(values).persist()
        self.model = KMeans(k=k, seed=seed).fit(points)
        self.customers = self.model.transform(points).withColumnRenamed("prediction", "segment").drop("features")
        self._placed = self.model.transform(points)

    def profile(self) -> DataFrame:
        """Per segment: its customers, its centre, and the silhouette of the
        whole clustering."""
        spark = self.customers.sparkSession
        centres = spark.createDataFrame(
            [(i, *c) for i, c in enumerate(self.centres())],
            "segment int, monetary double, frequency double, recency double",
        )
        sizes = self.customers.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
        return sizes.join(centres, "segment").withColumn("silhouette", F.lit(self.silhouette()))

    def silhouette(self) -> float:
        return ClusteringEvaluator().evaluate(self._placed)

    def centres(self) -> list[list[float]]:
        """Monetary, frequency and recency of each of the ``k`` centres."""
        return [list(map(float, c)) for c in self.model.clusterCenters()]
