"""Explicit schemas of every input; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PAYLOAD = _strings("card_id", "member_id", "amount", "postcode", "pos_id", "transaction_dt")

#: Text form of ``transaction_dt`` (fixed value).
TRANSACTION_DT_FORMAT = "dd-MM-yyyy HH:mm:ss"

CLASSIFIED_TRANSACTION = T.StructType(PAYLOAD.fields + [T.StructField("status", T.StringType())])

ZIPS = T.StructType(
    [
        T.StructField("zip", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("state_name", T.StringType()),
        T.StructField("post_id", T.StringType()),
    ]
)

CLICKSTREAM = _strings("user_id", "timestamp", "song_id", "date")
SONG_METADATA = _strings("song_id", "artist_id")
NOTIFICATION_CLICKS = _strings("notification_id", "user_id", "date")

# The columns of the accounts file, of which three are used.
ACCOUNTS = _strings(
    *"_unit_id _golden _unit_state _trusted_judgments _last_judgment_at gender gender:confidence profile_yn "
    "profile_yn:confidence created description fav_number gender_gold link_color name profile_yn_gold profileimage "
    "retweet_count sidebar_color text tweet_coord tweet_count tweet_created tweet_id tweet_location user_timezone".split()
)

CARD_MEMBER = T.StructType(
    [
        T.StructField("card_id", T.StringType()),
        T.StructField("member_id", T.StringType()),
        T.StructField("member_joining_dt", T.TimestampType()),
        T.StructField("card_purchase_dt", T.TimestampType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
    ]
)

MEMBER_SCORE = T.StructType(
    [T.StructField("member_id", T.StringType()), T.StructField("score", T.DoubleType())]
)

#: One row per card: control limit, credit score, last genuine place and time.
LOOKUP = T.StructType(
    [
        T.StructField("card_id", T.StringType()),
        T.StructField("ucl", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("postcode", T.StringType()),
        T.StructField("transaction_dt", T.StringType()),
        T.StructField("epoch", T.LongType()),
    ]
)

#: What one micro-batch changed in the lookup: place and time only.
MOVES = T.StructType([f for f in LOOKUP.fields if f.name not in ("ucl", "score")])
