"""Accounts classified by their text: cleaning, TF-IDF, two tree models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import IDF, HashingTF, IndexToString, StopWordsRemover, StringIndexer, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.functions import text as tx
from signalbook.functions.draw import thousandth

SEED = 42


def _known() -> F.Column:
    return (F.col("gender") != "unknown") & (F.col("gender") != "")


def _written() -> F.Column:
    # Cleaning keeps the length, so empty texts can be told before it.
    return F.col("text") != ""


def cleaned(accounts: DataFrame) -> DataFrame:
    """``(account_id, gender, text1)`` of the accounts worth training on.  A
    text of symbols alone becomes blanks and stays."""
    whole = accounts.select("account_id", "gender", "text").na.drop("any")
    return whole.filter(_known() & _written()).select(
        "account_id", "gender", tx.clean(F.col("text")).alias("text1")
    )


def stage_counts(accounts: DataFrame) -> DataFrame:
    """Accounts read, without nulls, with a known label, and with a text, all
    counted in one pass."""
    whole = F.col("account_id").isNotNull() & F.col("gender").isNotNull() & F.col("text").isNotNull()
    return accounts.agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(whole).alias("n_whole"),
        F.count_if(whole & _known()).alias("n_known"),
        F.count_if(whole & _known() & _written()).alias("n_kept"),
    )


def with_tokens(clean: DataFrame) -> DataFrame:
    return tx.add_tokens(clean, "text1", "words")


def with_terms(tokenized: DataFrame) -> DataFrame:
    """Tokens without English stop words."""
    return StopWordsRemover(inputCol="words", outputCol="filtered").transform(tokenized)


def term_idf(terms: DataFrame) -> DataFrame:
    """Document frequency and ``ln((m + 1) / (df + 1))`` of every term."""
    m = terms.count()
    # A document names each of its terms once, so no distinct is needed later.
    once = terms.select(F.explode(F.array_distinct("filtered")).alias("term"))
    counts = once.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.withColumn("idf", F.log(F.lit(float(m + 1)) / (F.col("df") + 1)))


def split_draw(key: str = "account_id", train_share: float = 0.7, seed: int = SEED) -> F.Column:
    """``train`` or ``test`` by a digest of the key, the same in every run."""
    return F.when(thousandth([key], seed) < int(train_share * 1000), "train").otherwise("test")


class Features:
    """TF-IDF features of both parts, computed once for all models.

    Labels are numbered over all accounts, so that the test part holds no
    unseen one; document frequencies come from the training part only.
    """

    def __init__(self, accounts: DataFrame, buckets: int = 1000, seed: int = SEED):
        clean = cleaned(accounts).withColumn("split", split_draw(seed=seed))
        labels = StringIndexer(inputCol="gender", outputCol="label").fit(clean)
        self.labels = labels.labels
        words = Pipeline(
            stages=[
                labels,
                Tokenizer(inputCol="text1", outputCol="words"),
                StopWordsRemover(inputCol="words", outputCol="filtered"),
                HashingTF(inputCol="filtered", outputCol="counts", numFeatures=buckets),
            ]
        )
        counted = words.fit(clean).transform(clean).select("account_id", "split", "gender", "label", "counts")
        # Texts differ in length by orders of magnitude and the trees pass over
        # the vectors many times, so these are spread evenly once.
        counted = counted.repartition("account_id").persist()
        weights = IDF(inputCol="counts", outputCol="features").fit(counted.filter("split = 'train'"))
        self.table = weights.transform(counted).drop("counts").persist()
        self.table.count()
        counted.unpersist()

    def release(self) -> None:
        self.table.unpersist()


def _models(seed: int):
    return {
        "random_forest": RandomForestClassifier(seed=seed),
        "decision_tree": DecisionTreeClassifier(seed=seed),
    }


def classify(features: Features, model: str, seed: int = SEED) -> DataFrame:
    """True and predicted label of every account, with its part."""
    fitted = _models(seed)[model].fit(features.table.filter("split = 'train'"))
    named = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=features.labels)
    return named.transform(fitted.transform(features.table)).select(
        F.lit(model).alias("model"), "account_id", "split", "gender", "predicted_label", "label", "prediction"
    )


def metrics(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and F1 per group of
    ``by``, from one confusion matrix: rows ``(*by, metric, value, percent)``."""
    by = by or []
    cells = predictions.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    true = cells.groupBy(*by, "label").agg(F.sum("n").alias("n_true"), F.sum(hit).alias("tp"))
    said = cells.groupBy(*by, F.col("prediction").alias("label")).agg(F.sum("n").alias("n_said"))
    per_label = true.join(said, [*by, "label"], "left")
    precision = F.coalesce(F.try_divide("tp", "n_said"), F.lit(0.0))
    recall = F.col("tp") / F.col("n_true")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))

    def weighted(x):
        return F.sum(F.col("n_true") * x) / F.sum("n_true")

    wide = per_label.groupBy(*by).agg(
        (F.sum("tp") / F.sum("n_true")).alias("accuracy"),
        weighted(precision).alias("weightedPrecision"),
        weighted(recall).alias("weightedRecall"),
        weighted(f1).alias("f1"),
    )
    names = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]
    return wide.unpivot(by, names, "metric", "value").withColumn("percent", F.round(F.col("value") * 100))
