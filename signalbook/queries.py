"""One DataFrame per question over the benchmark tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbook.functions.clock import epoch_of_ntz
from signalbook.operators.latest import not_loaded, reload_from, upsert
from signalbook.operators.top_products import top_products
from signalbook.plans import accounts as acc
from signalbook.plans import cohorts, fraud, rfm
from signalbook.session import checkpointed, new_dir
from signalbook.sources import files, topics
from signalbook.sources import tables as t
from signalbook.sources.tables import table
from signalbook.streaming import keyed, loading, scoring

DECISION = [*fraud.TRANSACTION, "km", "secs", "speed_rule", "amount_rule", "score_rule", "status"]


DAY = 86_400


def _events(spark, d):
    return table(spark, d, "events")


def _zips(spark, d):
    return t.zips(table(spark, d, "nation"))


def _lookup(spark, d):
    customer = table(spark, d, "customer")
    return fraud.build_lookup(
        t.history(_events(spark, d)), t.card_members(customer), t.member_scores(customer)
    )


def _clicks(spark, d):
    return t.clickstream(_events(spark, d))


def _given_cohorts(spark, d):
    return t.given_cohorts(table(spark, d, "embeddings"))


def _accounts(spark, d):
    return t.accounts(table(spark, d, "documents"))


# --- transactions ------------------------------------------------------------


def txn_parse(spark: SparkSession, d: str) -> DataFrame:
    return fraud.accepted(_parsed(spark, d))


def txn_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return fraud.quarantined(_parsed(spark, d)).select("txn_id", "reason")


def txn_faults(spark: SparkSession, d: str) -> DataFrame:
    """Records of which some are cut off, lack a field, or have a date that is
    none, as their ids have it, with all that was found wrong."""
    raw = t.records(_events(spark, d), whole_amounts=False).select(F.col("offset").alias("txn_id"), "value")
    n = F.col("txn_id")
    value = (
        F.when(n % 11 == 0, F.expr("left(value, length(value) - 1)"))
        .when(n % 13 == 0, F.regexp_replace("value", '"pos_id":"[^"]*",', ""))
        .when(n % 17 == 0, F.regexp_replace("value", '"transaction_dt":"..', '"transaction_dt":"39'))
        .when(n % 19 == 0, F.lit(None))
        .otherwise(F.col("value"))
    )
    parsed = fraud.parse_payloads(raw.withColumn("value", value))
    return fraud.quarantined(parsed).select("txn_id", "reason")


def _classified(spark, d):
    """Classified transactions as a CSV folder that was loaded, some rows bad."""
    events = _events(spark, d)
    n = F.col("txn_id")
    rows = t.history(events).select(
        "card_id",
        F.when(n % 23 != 0, F.col("member_id")).alias("member_id"),
        F.when(n % 29 == 0, F.concat(F.col("amount").cast("string"), F.lit(".5"))).otherwise(F.col("amount").cast("string")).alias("amount"),
        "postcode",
        "pos_id",
        F.when(n % 31 == 0, F.lit("soon")).otherwise(F.col("transaction_dt")).alias("transaction_dt"),
        F.when(F.col("amount") > 90, "FRAUD").otherwise("GENUINE").alias("status"),
    )
    path = new_dir(spark, "classified")
    rows.write.option("header", True).csv(path)
    return files.classified_transactions(spark, path)


def classified_load(spark: SparkSession, d: str) -> DataFrame:
    """What the first load takes of classified transactions, by day."""
    rows = fraud.typed(_classified(spark, d))
    return rows.groupBy("status", F.substring("transaction_dt", 1, 10).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.countDistinct("card_id").alias("cards"),
        F.sum("epoch").alias("epochs"),
    )


def classified_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """What it refuses, by fault."""
    return fraud.typed_faults(_classified(spark, d)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _parsed(spark, d):
    raw = t.records(_events(spark, d), whole_amounts=False)
    return fraud.parse_payloads(raw.select(F.col("offset").alias("txn_id"), "value"))


def zip_distance(spark: SparkSession, d: str) -> DataFrame:
    trips = fraud.journeys(t.arrivals(_events(spark, d)), _lookup(spark, d), _zips(spark, d))
    return trips.groupBy("last_postcode", "postcode").agg(
        F.count(F.lit(1)).alias("journeys"), F.max("km").alias("km")
    )


def txn_speed(spark: SparkSession, d: str) -> DataFrame:
    trips = fraud.journeys(t.arrivals(_events(spark, d)), _lookup(spark, d), _zips(spark, d))
    return trips.select("txn_id", "card_id", "km", "secs", F.round("speed", 6).alias("speed"))


def last10_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = fraud.last_n_stats(t.transactions(_events(spark, d)))
    return stats.select(
        "card_id", "n", *[F.round(c, 4).alias(c) for c in ("moving_avg", "moving_std", "ucl")]
    )


def rolling10(spark: SparkSession, d: str) -> DataFrame:
    stats = fraud.rolling_stats(t.transactions(_events(spark, d)))
    return stats.select("txn_id", "card_id", "n", *[F.round(c, 4).alias(c) for c in ("moving_avg", "moving_std")])


def latest_location(spark: SparkSession, d: str) -> DataFrame:
    return fraud.latest_location(t.transactions(_events(spark, d)))


def lookup_build(spark: SparkSession, d: str) -> DataFrame:
    return _lookup(spark, d).withColumn("ucl", F.round("ucl", 4))


def incremental_load(spark: SparkSession, d: str) -> DataFrame:
    events = _events(spark, d)
    first = fraud.latest_location(t.history(events)).withColumn("txn_id", F.lit(-1).cast("bigint"))
    loaded = checkpointed(first)  # as the stored table of an earlier load
    since = t.events_since(events, reload_from(loaded, "epoch", overlap=DAY))
    fresh = t.transactions(since).select(*loaded.columns)
    return upsert(loaded, fresh, "card_id", fraud.ORDER).drop("txn_id")


def incremental_replay(spark: SparkSession, d: str) -> DataFrame:
    """The lookup, limits and scores included, after two loads of which the
    second brings rows of the boundary and of the day before it that were late."""
    events = _events(spark, d)
    late = (F.col("ts") >= F.expr(f"timestamp_ntz'{t.CUTOFF}' - interval 1 day")) & (F.col("event_id") % 3 == 0)
    loaded = checkpointed(t.transactions(t.before(events, t.CUTOFF).filter(~late)))  # an earlier load
    since = t.events_since(events, reload_from(loaded, "epoch", overlap=DAY))
    fresh = not_loaded(t.transactions(since), loaded, "txn_id")
    customer = table(spark, d, "customer")
    lookup = fraud.build_lookup(loaded.unionByName(fresh), t.card_members(customer), t.member_scores(customer))
    return lookup.withColumn("ucl", F.round("ucl", 4))


LOADS = 3


def _arrived(spark, d):
    """A store of loads into which the transactions came in files, rows of
    any age in each, and some again that had come before."""
    events = _events(spark, d)
    past = F.col("ts") < F.lit(t.CUTOFF).cast("timestamp_ntz")
    comes = F.when(past & (F.col("event_id") % 3 != 0), 0).otherwise(1 + F.col("event_id") % 2)
    again = F.when(F.col("event_id") % 7 == 0, 1).when(F.col("event_id") % 5 == 0, 2)
    store = new_dir(spark, "arrivals")
    day = F.to_date(F.substring("transaction_dt", 1, 10), "dd-MM-yyyy").alias("event_date")
    for number in range(LOADS):
        sent = events.filter((comes == number) | ((comes < number) & (again == number)))
        rows = t.transactions(sent).select("*", day)
        rows.write.parquet(f"{store}/files/{number}")
        arriving = spark.readStream.schema(rows.schema).parquet(f"{store}/files/*")
        loading.load(arriving, store, "event_date").awaitTermination()
    return store, rows.schema


def incremental_late(spark: SparkSession, d: str) -> DataFrame:
    """Every transaction with the load that it first came in."""
    store, schema = _arrived(spark, d)
    return loading.loaded(spark, store, schema, "event_date").select(*fraud.TRANSACTION, "load")


def incremental_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The lookup after these loads, of which each read only its own rows and
    the newest ones of each card before it."""
    store, _ = _arrived(spark, d)
    customer = table(spark, d, "customer")
    newest = loading.newest_before(spark, store, LOADS)
    lookup = fraud.build_lookup(newest, t.card_members(customer), t.member_scores(customer))
    return lookup.withColumn("ucl", F.round("ucl", 4))


def customer_view(spark: SparkSession, d: str) -> DataFrame:
    customer = table(spark, d, "customer")
    return fraud.customer_view(
        t.card_members(customer), t.member_scores(customer), t.transactions(_events(spark, d))
    )


def customer_view_live(spark: SparkSession, d: str) -> DataFrame:
    """The view after all arrivals, with verdicts and the moved lookup."""
    customer = table(spark, d, "customer")
    lookup = checkpointed(_lookup(spark, d))
    scored = checkpointed(fraud.score_transactions(t.arrivals(_events(spark, d)), lookup, _zips(spark, d)))
    moved = fraud.move_lookup(lookup, fraud.closing_places(scored))
    view = fraud.live_view(t.card_members(customer), t.member_scores(customer), scored, moved)
    return view.withColumn("ucl", F.round("ucl", 4))


def fraud_rules(spark: SparkSession, d: str) -> DataFrame:
    return fraud.apply_rules(t.arrivals(_events(spark, d)), _lookup(spark, d), _zips(spark, d))


def fraud_score(spark: SparkSession, d: str) -> DataFrame:
    return fraud.score_transactions(t.arrivals(_events(spark, d)), _lookup(spark, d), _zips(spark, d))


def stream_fraud(spark: SparkSession, d: str) -> DataFrame:
    """The arrivals as a stream of JSON records, scored and read back."""
    schema = _events(spark, d).schema
    # A pattern, as a file stream takes a plain path for a folder.
    events = spark.readStream.schema(schema).parquet(f"{d}/{{events}}.parquet")
    arriving = events.filter(F.col("ts") >= F.lit(t.CUTOFF).cast("timestamp_ntz"))
    store = new_dir(spark, "stream_fraud")
    query = scoring.start(t.records(arriving), _lookup(spark, d), _zips(spark, d), store, interval=None)
    query.awaitTermination()
    return scoring.decisions(spark, store).select("decision_id", *DECISION)


FILES = 4


def stream_fraud_keyed(spark: SparkSession, d: str) -> DataFrame:
    """The arrivals as topic records in files by time, one file a batch, the
    query stopped and started again after half of them; places in operator state."""
    events = _events(spark, d)
    arriving = events.filter(F.col("ts") >= F.lit(t.CUTOFF).cast("timestamp_ntz"))
    # Three days a file; the last one has the rest.
    after = epoch_of_ntz("ts") - F.unix_seconds(F.to_timestamp(F.lit(t.CUTOFF + "Z")))
    part = F.least(F.lit(FILES - 1), F.floor(after / (3 * DAY))).cast("int")
    store = new_dir(spark, "stream_fraud_keyed")
    for number in range(FILES):
        t.records(arriving.filter(part == number)).repartition(1).write.json(f"{store}/files/{number}")
        if number % 2:
            stream = topics.json_files(spark, f"{store}/files/*", files_per_batch=1)
            keyed.start(stream, _lookup(spark, d), _zips(spark, d), store, interval=None).awaitTermination()
    return keyed.decisions(spark, store).select("decision_id", *DECISION)


def lookup_moved(spark: SparkSession, d: str) -> DataFrame:
    """The lookup after all arrivals."""
    lookup = _lookup(spark, d)
    scored = fraud.score_transactions(t.arrivals(_events(spark, d)), lookup, _zips(spark, d))
    return fraud.move_lookup(lookup, fraud.closing_places(scored)).withColumn("ucl", F.round("ucl", 4))


# --- cohorts -----------------------------------------------------------------


def play_frequency(spark: SparkSession, d: str) -> DataFrame:
    return cohorts.play_frequency(_clicks(spark, d))


def label_index(spark: SparkSession, d: str) -> DataFrame:
    return cohorts.label_index(cohorts.play_frequency(_clicks(spark, d)), "user_id", "user_index")


def cohort_clicks(spark: SparkSession, d: str) -> DataFrame:
    joined = cohorts.cohort_clicks(_clicks(spark, d), _given_cohorts(spark, d))
    return joined.select("user_id", "song_id", "cluster")


def click_artist(spark: SparkSession, d: str) -> DataFrame:
    metadata = t.song_metadata(table(spark, d, "part"))
    return cohorts.cohort_artists(_clicks(spark, d), _given_cohorts(spark, d), metadata)


def notification_clicks(spark: SparkSession, d: str) -> DataFrame:
    clicks = t.notification_clicks(_events(spark, d))
    return clicks.groupBy("notification_id", "date").agg(
        F.count(F.lit(1)).alias("clicks"), F.countDistinct("user_id").alias("users")
    )


def _rates(spark, d):
    return cohorts.click_through(_given_cohorts(spark, d), t.notification_clicks(_events(spark, d)))


def cohort_ctr(spark: SparkSession, d: str) -> DataFrame:
    return _rates(spark, d)


def cohort_best(spark: SparkSession, d: str) -> DataFrame:
    return cohorts.best_notification(_rates(spark, d))


def fitted_cohort_clicks(spark: SparkSession, d: str) -> DataFrame:
    """Clicks beside the fitted cohort of their listener, as counts."""
    clicks = _clicks(spark, d)
    joined = cohorts.cohort_clicks(clicks, cohorts.assign_cohorts(clicks))
    return joined.groupBy("cluster", "user_id").agg(F.count(F.lit(1)).alias("clicks"))


def fitted_cohort_ctr(spark: SparkSession, d: str) -> DataFrame:
    """Rates of notifications per fitted cohort."""
    fitted = cohorts.assign_cohorts(_clicks(spark, d))
    return cohorts.click_through(fitted, t.notification_clicks(_events(spark, d)))


def frequency_with_cohort(spark: SparkSession, d: str) -> DataFrame:
    """Play counts beside the fitted cohort of their listener."""
    clicks = _clicks(spark, d)
    return cohorts.play_frequency(clicks).join(cohorts.assign_cohorts(clicks), "user_id")


def cohort_assign(spark: SparkSession, d: str) -> DataFrame:
    return cohorts.assign_cohorts(_clicks(spark, d))


def top_songs(spark: SparkSession, d: str) -> DataFrame:
    return cohorts.top_songs(_clicks(spark, d))


def top_partners(spark: SparkSession, d: str) -> DataFrame:
    """The best partners by given factors, in whole numbers so that scores tie."""
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * 16).cast("double"))
    given = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), whole.alias("features"))
    asks = F.col("id") % 4 == 1
    best = top_products(given.filter(asks), given.filter(~asks), 10)
    return best.select(F.col("asking").alias("user"), F.col("offered").alias("song"), "rank", "score")


def top_listeners(spark: SparkSession, d: str) -> DataFrame:
    return cohorts.top_listeners(_clicks(spark, d))


def held_out_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Held-out pairs that a model fitted on the others predicts."""
    return cohorts.predictable(cohorts.held_out(cohorts.play_frequency(_clicks(spark, d))))


def als_rmse(spark: SparkSession, d: str) -> DataFrame:
    return cohorts.factor_error(_clicks(spark, d))


# --- accounts ----------------------------------------------------------------


def first_accounts(spark: SparkSession, d: str) -> DataFrame:
    """The first ten accounts that will be trained on, as a report shows them."""
    return acc.cleaned(_accounts(spark, d)).orderBy("account_id").limit(10)


def account_counts(spark: SparkSession, d: str) -> DataFrame:
    return acc.stage_counts(_accounts(spark, d))


def text_clean(spark: SparkSession, d: str) -> DataFrame:
    return acc.cleaned(_accounts(spark, d))


def account_split(spark: SparkSession, d: str) -> DataFrame:
    """The part that each account falls into."""
    return acc.cleaned(_accounts(spark, d)).select("account_id", acc.split_draw().alias("split"))


def text_tokens(spark: SparkSession, d: str) -> DataFrame:
    tokens = acc.with_tokens(acc.cleaned(_accounts(spark, d)))
    return tokens.select(
        "account_id", F.size("words").cast("bigint").alias("n_tokens"), F.array_join("words", "|").alias("tokens")
    )


def _terms(spark, d):
    return acc.with_terms(acc.with_tokens(acc.cleaned(_accounts(spark, d))))


def text_terms(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).select(
        "account_id", F.size("filtered").cast("bigint").alias("n_terms"), F.array_join("filtered", "|").alias("terms")
    )


def term_idf(spark: SparkSession, d: str) -> DataFrame:
    return acc.term_idf(_terms(spark, d)).withColumn("idf", F.round("idf", 6))


def classification_metrics(spark: SparkSession, d: str) -> DataFrame:
    scores = acc.metrics(t.fixed_predictions(table(spark, d, "labels")))
    return scores.withColumn("value", F.round("value", 6))


def classify_rf(spark: SparkSession, d: str) -> DataFrame:
    return acc.classify(acc.Features(_accounts(spark, d)), "random_forest")


def classify_dt(spark: SparkSession, d: str) -> DataFrame:
    return acc.classify(acc.Features(_accounts(spark, d)), "decision_tree")


def model_comparison(spark: SparkSession, d: str) -> DataFrame:
    features = acc.Features(_accounts(spark, d))
    both = acc.classify(features, "random_forest").unionByName(acc.classify(features, "decision_tree"))
    return acc.metrics(both, ["model", "split"])


# --- customers ---------------------------------------------------------------


def _rfm(spark, d):
    lines = t.retail(table(spark, d, "orders"), table(spark, d, "lineitem"))
    return rfm.rfm(lines, t.AS_OF)


def rfm_values(spark: SparkSession, d: str) -> DataFrame:
    return _rfm(spark, d)


def rfm_segments(spark: SparkSession, d: str) -> DataFrame:
    return rfm.Segments(_rfm(spark, d)).customers


def rfm_profile(spark: SparkSession, d: str) -> DataFrame:
    return rfm.Segments(_rfm(spark, d)).profile()


QUERIES = {
    "txn_parse": txn_parse,
    "txn_quarantine": txn_quarantine,
    "txn_faults": txn_faults,
    "classified_load": classified_load,
    "classified_quarantine": classified_quarantine,
    "zip_distance": zip_distance,
    "txn_speed": txn_speed,
    "last10_stats": last10_stats,
    "rolling10": rolling10,
    "latest_location": latest_location,
    "lookup_build": lookup_build,
    "incremental_load": incremental_load,
    "incremental_replay": incremental_replay,
    "incremental_late": incremental_late,
    "incremental_lookup": incremental_lookup,
    "customer_view": customer_view,
    "customer_view_live": customer_view_live,
    "fraud_rules": fraud_rules,
    "fraud_score": fraud_score,
    "stream_fraud": stream_fraud,
    "stream_fraud_keyed": stream_fraud_keyed,
    "lookup_moved": lookup_moved,
    "play_frequency": play_frequency,
    "label_index": label_index,
    "cohort_clicks": cohort_clicks,
    "fitted_cohort_clicks": fitted_cohort_clicks,
    "fitted_cohort_ctr": fitted_cohort_ctr,
    "frequency_with_cohort": frequency_with_cohort,
    "click_artist": click_artist,
    "notification_clicks": notification_clicks,
    "cohort_ctr": cohort_ctr,
    "cohort_best": cohort_best,
    "cohort_assign": cohort_assign,
    "top_songs": top_songs,
    "top_listeners": top_listeners,
    "top_partners": top_partners,
    "als_rmse": als_rmse,
    "held_out_pairs": held_out_pairs,
    "first_accounts": first_accounts,
    "account_counts": account_counts,
    "text_clean": text_clean,
    "account_split": account_split,
    "text_tokens": text_tokens,
    "text_terms": text_terms,
    "term_idf": term_idf,
    "classification_metrics": classification_metrics,
    "classify_rf": classify_rf,
    "classify_dt": classify_dt,
    "model_comparison": model_comparison,
    "rfm": rfm_values,
    "rfm_segments": rfm_segments,
    "rfm_profile": rfm_profile,
}
