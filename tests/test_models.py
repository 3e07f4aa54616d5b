"""Invariants of the fitted models, and metrics against their definition."""

import math
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, Tokenizer
from pyspark.sql import functions as F

from signalbook import oracle
from signalbook.plans import accounts as acc
from signalbook.plans import cohorts, rfm
from signalbook.queries import _accounts, _clicks, _rfm


@pytest.fixture(scope="module")
def clicks(spark, tiny):
    return _clicks(spark, tiny).cache()


@pytest.fixture(scope="module")
def features(spark, small):
    return acc.Features(_accounts(spark, small))


def test_label_index_is_the_indexer_of_the_library(spark, clicks):
    freq = cohorts.play_frequency(clicks)
    ours = {r.song_id: float(r["at"]) for r in cohorts.label_index(freq, "song_id", "at").collect()}
    theirs = StringIndexer(inputCol="song_id", outputCol="at").fit(freq).labels
    assert ours == {label: float(i) for i, label in enumerate(theirs)}


def test_cohorts_cover_every_listener_once_and_repeat(clicks):
    first = sorted(tuple(r) for r in cohorts.assign_cohorts(clicks, k=4).collect())
    again = sorted(tuple(r) for r in cohorts.assign_cohorts(clicks.repartition(5), k=4).collect())
    assert first == again
    users = {r.user_id for r in clicks.select("user_id").distinct().collect()}
    assert {u for u, _ in first} == users and len(first) == len(users)
    assert {c for _, c in first} <= set(range(4))


def test_ranks_follow_scores(clicks):
    for rows, key in ((cohorts.top_songs(clicks, 3), "user_id"), (cohorts.top_listeners(clicks, 3), "song_id")):
        by = {}
        for r in rows.collect():
            by.setdefault(r[key], {})[r["rank"]] = r.score
        assert all(list(sorted(s)) == [1, 2, 3] and s[1] >= s[2] >= s[3] for s in by.values())


def test_factor_error_is_finite(clicks):
    row = cohorts.factor_error(clicks).first()
    assert row.predicted_pairs > 0 and math.isfinite(row.rmse) and row.rmse > 0


def test_best_notification_takes_the_first_of_equals(spark):
    rates = spark.createDataFrame(
        [(0, "b", 2, 4, 0.5), (0, "a", 2, 4, 0.5), (0, "c", 1, 4, 0.25), (1, "c", 1, 9, 1 / 9)],
        "cluster int, notification_id string, clickers long, cohort_size long, ctr double",
    )
    got = {r.cluster: r.notification_id for r in cohorts.best_notification(rates).collect()}
    assert got == {0: "a", 1: "c"}


def test_tokens_are_those_of_the_tokenizer(spark):
    texts = [" Hi  there  ", "a", "A b C", "   x", "one two   "]
    df = spark.createDataFrame([(s,) for s in texts], "text1 string")
    theirs = [r.words for r in Tokenizer(inputCol="text1", outputCol="words").transform(df).collect()]
    assert [r.words for r in acc.with_tokens(df).collect()] == theirs


def test_stop_words_of_the_twin_are_those_of_the_library(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert StopWordsRemover.loadDefaultStopWords("english") == oracle.STOP_WORDS


@pytest.mark.parametrize("model", ["random_forest", "decision_tree"])
def test_classifier_and_its_metrics(features, model):
    predicted = acc.classify(features, model).cache()
    assert predicted.count() == features.table.count()
    parts = Counter(r.split for r in predicted.collect())
    assert 0.6 < parts["train"] / sum(parts.values()) < 0.8
    assert {r.predicted_label for r in predicted.collect()} <= set(features.labels)
    ours = {(r.split, r.metric): r.value for r in acc.metrics(predicted, ["split"]).collect()}
    for split in parts:
        rows = predicted.filter(F.col("split") == split)
        for name in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
            theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(rows)
            assert ours[split, name] == pytest.approx(theirs, abs=1e-9)
    right = predicted.filter(F.col("label") == F.col("prediction"))
    assert right.filter("gender != predicted_label").count() == 0


def test_metrics_with_a_label_never_predicted(spark):
    rows = [(0.0, 0.0)] * 5 + [(1.0, 0.0)] * 3 + [(2.0, 2.0)] * 2 + [(0.0, 3.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = {r.metric: (r.value, r.percent) for r in acc.metrics(df).collect()}
    for name, (value, percent) in ours.items():
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert value == pytest.approx(theirs, abs=1e-12)
        assert percent == math.floor(theirs * 100 + 0.5)


def test_rfm_by_hand(spark):
    lines = spark.createDataFrame(
        [
            ("c", "i1", "01/05/2020 10:00", 2, 1.25),
            ("c", "i1", "01/05/2020 10:00", 1, 0.5),
            ("c", "i2", "01/09/2020 23:59", 1, 10.0),
            ("d", "i3", "12/31/2019 00:00", 3, 1.0),
            (None, "i4", "12/31/2019 00:00", 3, 1.0),
        ],
        "CustomerID string, InvoiceNo string, InvoiceDate string, Quantity int, UnitPrice double",
    )
    got = {r.CustomerID: (r.Recency, r.Frequency, r.Monetary) for r in rfm.rfm(lines, "2020-01-10").collect()}
    assert got == {"c": (1, 2, 13.0), "d": (10, 1, 3.0)}


def test_segments(spark, tiny):
    values = _rfm(spark, tiny).cache()
    segments = rfm.Segments(values)
    rows = segments.customers.collect()
    assert len(rows) == values.count() and {r.segment for r in rows} == {0, 1, 2}
    assert -1.0 <= segments.silhouette() <= 1.0
    centres = segments.centres()
    for r in rows:
        point = (r.Monetary, r.Frequency, r.Recency)
        dist = [math.dist(point, c) for c in centres]
        assert dist[r.segment] == pytest.approx(min(dist))
