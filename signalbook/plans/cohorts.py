"""Listener cohorts: play counts, factors, clusters, click-through rates."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalbook.functions.draw import thousandth
from signalbook.operators.dense_index import dense_index
from signalbook.operators.skew import dimension_join, salted_join
from signalbook.operators.top_products import top_products
from signalbook.session import shared_dir

SEED = 42


def play_frequency(clicks: DataFrame) -> DataFrame:
    """Plays per user and song; clicks without either are dropped."""
    return (
        clicks.select("user_id", "song_id")
        .na.drop("any")
        .groupBy("user_id", "song_id")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def label_index(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """``(column, n, name)``: labels numbered from the most frequent on, ties
    in alphabetical order.  Labels stay in Spark, so there may be any number
    of them."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return dense_index(counts, [F.desc("n"), F.asc(column)], name)


class Listening:
    """Play counts with numbered users and songs, ready for factoring; with a
    ``train_share``, also the part of each pair."""

    def __init__(self, clicks: DataFrame, train_share: float | None = None, seed: int = SEED):
        frequency = play_frequency(clicks)
        part = []
        if train_share is not None:
            frequency, part = held_out(frequency, train_share, seed), ["part"]
        frequency = frequency.persist()
        self.users = label_index(frequency, "user_id", "user").drop("n")
        self.songs = label_index(frequency, "song_id", "song").drop("n")
        numbered = dimension_join(frequency, self.songs, "song_id", "inner", spread_by=["user_id"])
        numbered = dimension_join(numbered, self.users, "user_id", "inner", spread_by=["song_id"])
        # One layout for every run, as the factors depend on it a little.
        self.ratings = (
            numbered.select("user", "song", F.col("frequency").cast("float").alias("frequency"), *part)
            .repartition(_parts(clicks.sparkSession), "user", "song")
            .sortWithinPartitions("user", "song")
            .persist()
        )
        self.ratings.count()
        frequency.unpersist()


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fit_factors(
    ratings: DataFrame, rank: int = 10, iterations: int = 5, reg: float = 0.01, seed: int = SEED
) -> ALSModel:
    """Explicit-feedback factors of users and songs."""
    spark = ratings.sparkSession
    shared_dir(spark)
    als = ALS(
        rank=rank, maxIter=iterations, regParam=reg, implicitPrefs=False, seed=seed,
        userCol="user", itemCol="song", ratingCol="frequency", coldStartStrategy="drop",
    )
    # Songs are far fewer than users.
    users, songs = max(10, _parts(spark)), max(10, _parts(spark) // 8)
    return als.setNumUserBlocks(users).setNumItemBlocks(songs).fit(ratings)


def assign_cohorts(clicks: DataFrame, k: int = 10, seed: int = SEED) -> DataFrame:
    """``(user_id, cluster)``: k-means over the users' factors."""
    listening = Listening(clicks)
    model = fit_factors(listening.ratings, seed=seed)
    listening.ratings.unpersist()
    points = model.userFactors.select("id", array_to_vector("features").alias("features")).persist()
    clusters = KMeans(k=k, seed=seed).fit(points)
    points.unpersist()
    placed = clusters.transform(points).select(F.col("id").alias("user"), F.col("prediction").alias("cluster"))
    # One row per user on both sides; the join turns numbers back into names.
    return placed.join(listening.users, "user").select("user_id", "cluster")


def cohort_clicks(clicks: DataFrame, cohorts: DataFrame) -> DataFrame:
    """One row per click of a user with a cohort."""
    plays = clicks.select("user_id", "song_id").na.drop("any")
    # By the song too: a salt that is the same when a lost stage runs again.
    return salted_join(plays, cohorts, "user_id", "inner", spread_by=["song_id"])


def cohort_artists(clicks: DataFrame, cohorts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Distinct ``(cluster, user, song, artist)``.  Clicks are made distinct
    before they are joined, so repeated plays are not carried along."""
    plays = clicks.select("user_id", "song_id").na.drop("any").distinct()
    placed = salted_join(plays, cohorts.distinct(), "user_id", "inner", spread_by=["song_id"])
    return dimension_join(placed, metadata.distinct(), "song_id", "inner", spread_by=["user_id"]).select(
        "cluster", "user_id", "song_id", "artist_id"
    )


def click_through(cohorts: DataFrame, notification_clicks: DataFrame) -> DataFrame:
    """Per cohort and notification: users who clicked over users in the cohort.

    The clicks say nothing about pushes, so the whole cohort counts as pushed
    to, as in a campaign that targets cohorts.
    """
    members = cohorts.select("user_id", "cluster").distinct()
    # One row per cohort, of which there are as many as the clustering was told to make.
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("cohort_size"))
    # Distinct first: a user then has at most one row per notification.
    clickers = notification_clicks.select("notification_id", "user_id").na.drop("any").distinct()
    clicked = (
        clickers.join(members, "user_id")
        .groupBy("cluster", "notification_id")
        .agg(F.count(F.lit(1)).alias("clickers"))
    )
    return clicked.join(F.broadcast(size), "cluster").withColumn("ctr", F.col("clickers") / F.col("cohort_size"))


def best_notification(rates: DataFrame) -> DataFrame:
    """The notification with the highest rate in each cohort."""
    w = Window.partitionBy("cluster").orderBy(F.desc("ctr"), F.asc("notification_id"))
    return rates.withColumn("rank", F.row_number().over(w)).filter("rank = 1").drop("rank")


def top_songs(clicks: DataFrame, n: int = 10, seed: int = SEED) -> DataFrame:
    """The ``n`` songs with the highest predicted frequency for each user,
    equal ones by number."""
    listening, model = _fitted(clicks, seed)
    best = top_products(model.userFactors, model.itemFactors, n)
    return _named(best.withColumnsRenamed({"asking": "user", "offered": "song"}), listening)


def top_listeners(clicks: DataFrame, n: int = 10, seed: int = SEED) -> DataFrame:
    """The ``n`` users with the highest predicted frequency for each song,
    equal ones by number."""
    listening, model = _fitted(clicks, seed)
    best = top_products(model.itemFactors, model.userFactors, n)
    return _named(best.withColumnsRenamed({"asking": "song", "offered": "user"}), listening)


def _fitted(clicks: DataFrame, seed: int):
    listening = Listening(clicks)
    model = fit_factors(listening.ratings, seed=seed)
    listening.ratings.unpersist()
    return listening, model


def _named(scored: DataFrame, listening: Listening) -> DataFrame:
    by_song = dimension_join(scored, listening.songs, "song", "inner", spread_by=["user"])
    by_user = dimension_join(by_song, listening.users, "user", "inner", spread_by=["song"])
    return by_user.select("user_id", "song_id", "rank", "score")


def held_out(frequency: DataFrame, train_share: float = 0.8, seed: int = SEED) -> DataFrame:
    """Play counts with ``part``, ``train`` or ``test`` by a digest of the pair."""
    draw = thousandth(["user_id", "song_id"], seed) < int(train_share * 1000)
    return frequency.withColumn("part", F.when(draw, "train").otherwise("test"))


def predictable(parted: DataFrame) -> DataFrame:
    """The test pairs whose user and song the training part knows: those that
    a model fitted on it predicts, as cold starts are dropped."""
    train, test = (parted.filter(F.col("part") == p).drop("part") for p in ("train", "test"))
    known = test.join(train.select("user_id").distinct(), "user_id", "left_semi")
    return known.join(train.select("song_id").distinct(), "song_id", "left_semi")


def factor_error(clicks: DataFrame, train_share: float = 0.8, seed: int = SEED) -> DataFrame:
    """Root mean square error of predicted frequencies on held-out pairs."""
    ratings = Listening(clicks, train_share, seed).ratings
    train, test = (ratings.filter(F.col("part") == p).drop("part") for p in ("train", "test"))
    predicted = fit_factors(train, seed=seed).transform(test).persist()
    rmse = RegressionEvaluator(metricName="rmse", labelCol="frequency").evaluate(predicted)
    n = predicted.count()
    predicted.unpersist()
    ratings.unpersist()
    return clicks.sparkSession.createDataFrame([(n, rmse)], "predicted_pairs long, rmse double")
