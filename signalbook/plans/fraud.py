"""Card transactions: parsing, the lookup of each card, and the three rules.

A transaction table has the columns ``txn_id, card_id, member_id, amount,
postcode, pos_id, transaction_dt, epoch``; ``(epoch, txn_id)`` orders the
transactions of a card.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalbook.functions.clock import parse_epoch
from signalbook.functions.geo import distance_km, too_fast, truncate2
from signalbook.functions.stats import mean_of, moments, stddev_pop_of
from signalbook.operators import journey_fold as fold
from signalbook.operators.latest import newest_rows
from signalbook.operators.rolling import trailing_stats
from signalbook.operators.skew import dimension_join, is_small, salted_join, split_heavy
from signalbook.schemas import LOOKUP, PAYLOAD
from signalbook.session import checkpointed

ORDER = ["epoch", "txn_id"]
#: Transactions of a card that its limit rests on.
LAST = 10
#: What :func:`newest_rows_of` keeps of a transaction.
NEWEST = "card_id string, amount int, postcode string, transaction_dt string, epoch bigint, txn_id bigint"
TRANSACTION = ["txn_id", *PAYLOAD.fieldNames(), "epoch"]


#: What can be wrong with a record, the first that applies.
FAULTS = ["MALFORMED_JSON", "MISSING_FIELD", "BAD_AMOUNT", "BAD_DATE"]


# --- parsing ---------------------------------------------------------------


def parse_payloads(raw: DataFrame) -> DataFrame:
    """``(txn_id, value)`` with JSON values to transactions plus ``reason``,
    which is null for a good record and names the fault of a bad one."""
    schema = T.StructType([*PAYLOAD.fields, T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    # As a generator the parse runs once per record; as a plain column, a
    # later filter on the fault would repeat it for every field it looks at.
    parsed = raw.select("*", F.inline(F.array(F.from_json("value", schema, options))))
    missing = F.greatest(*[F.col(n).isNull() for n in PAYLOAD.fieldNames()])
    whole = F.col("amount").rlike("^[+-]?[0-9]+$")
    typed = parsed.withColumns(
        {
            "_broken": F.col("_corrupt").isNotNull() | F.col("value").isNull(),
            "_missing": missing,
            "amount": F.when(whole, F.col("amount").try_cast("int")),
            "epoch": parse_epoch(F.col("transaction_dt")),
        }
    )
    reason = (
        F.when(F.col("_broken"), "MALFORMED_JSON")
        .when(F.col("_missing"), "MISSING_FIELD")
        .when(F.col("amount").isNull(), "BAD_AMOUNT")
        .when(F.col("epoch").isNull(), "BAD_DATE")
    )
    return typed.withColumn("reason", reason).drop("_corrupt", "_broken", "_missing")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reason is null").select(*TRANSACTION)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reason is not null").select("txn_id", "value", "reason")


def typed(classified: DataFrame) -> DataFrame:
    """Already classified transactions, read as text, with typed columns and a
    ``txn_id`` that is the same in every load; only rows without a fault."""
    return _classified(classified).filter("reason is null").drop("reason", "value")


def typed_faults(classified: DataFrame) -> DataFrame:
    """The other rows: ``txn_id``, the row as JSON and its fault."""
    return _classified(classified).filter("reason is not null").select("txn_id", "value", "reason")


def _classified(classified: DataFrame) -> DataFrame:
    """``row_id`` is a digest of all fields, for telling rows of different loads
    apart; ``txn_id`` a shorter one, for their order."""
    fields = PAYLOAD.fieldNames()
    amount = F.when(F.col("amount").rlike("^[+-]?[0-9]+$"), F.col("amount").try_cast("int"))
    epoch = parse_epoch(F.col("transaction_dt"))
    reason = (
        F.when(F.greatest(*[F.col(n).isNull() for n in fields]), "MISSING_FIELD")
        .when(amount.isNull(), "BAD_AMOUNT")
        .when(epoch.isNull(), "BAD_DATE")
    )
    return classified.select(
        F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256).alias("row_id"),
        F.xxhash64(*fields).alias("txn_id"),
        *[amount.alias(n) if n == "amount" else n for n in fields],
        epoch.alias("epoch"),
        "status",
        F.to_json(F.struct(*fields, "status")).alias("value"),
        reason.alias("reason"),
    )


# --- batch statistics and the lookup ----------------------------------------


def last_n_stats(tx: DataFrame, n: int = LAST, k: float = 3.0) -> DataFrame:
    """Per card over its newest ``n`` transactions: average, deviation, the
    control limit ``average + k * deviation``, and the newest place and time."""
    cnt, s1, s2 = moments(F.col("amount"))
    newest = newest_rows(tx.select("card_id", "amount", "postcode", "transaction_dt", *ORDER), "card_id", ORDER, n)
    last = F.min_by(F.struct("postcode", "transaction_dt", "epoch"), "rank")
    per_card = newest.groupBy("card_id").agg(
        cnt.alias("n"), s1.alias("_s1"), s2.alias("_s2"), last.alias("_last")
    )
    return per_card.select(
        "card_id",
        "n",
        mean_of(F.col("n"), F.col("_s1")).alias("moving_avg"),
        stddev_pop_of(F.col("n"), F.col("_s1"), F.col("_s2")).alias("moving_std"),
        "_last.*",
    ).withColumn("ucl", F.col("moving_avg") + F.lit(float(k)) * F.col("moving_std"))


def newest_rows_of(tx: DataFrame, n: int = LAST) -> DataFrame:
    """The newest ``n`` transactions of each card: all that its limit and its
    last place rest on.  Such tables of several loads merge into that of their
    union, whatever the order in which rows arrived."""
    kept = tx.select("card_id", "amount", "postcode", "transaction_dt", *ORDER)
    return newest_rows(kept, "card_id", ORDER, n).drop("rank")


def merged_newest(one: DataFrame, other: DataFrame, n: int = LAST) -> DataFrame:
    """The newest rows of the union of two loads, from the newest rows of each.
    The loads must not share transactions."""
    return newest_rows_of(one.unionByName(other), n)


def rolling_stats(tx: DataFrame, n: int = 10, rows_per_task: int | None = None) -> DataFrame:
    """Average and deviation of the ``n`` transactions up to each one."""
    narrow = tx.select("txn_id", "card_id", "amount", "epoch")
    return trailing_stats(narrow, "card_id", ORDER, "amount", n, rows_per_task)


def latest_location(tx: DataFrame, key: str = "card_id") -> DataFrame:
    """Newest postcode and time per card (or per member)."""
    newest = newest_rows(tx.select(key, "postcode", "transaction_dt", *ORDER), key, ORDER, 1)
    return newest.select(key, "postcode", "transaction_dt", "epoch")


def build_lookup(
    tx: DataFrame,
    card_member: DataFrame,
    member_score: DataFrame,
    k: float = 3.0,
    only_genuine: bool = False,
) -> DataFrame:
    """One lookup row per card with history, a member and a score."""
    if only_genuine:
        tx = tx.filter(F.col("status") == "GENUINE")
    # All three sides have one row per key, so no key is heavy.
    return (
        last_n_stats(tx, k=k)
        .join(card_member.select("card_id", "member_id"), "card_id")
        .join(member_score.select("member_id", "score"), "member_id")
        .select(*LOOKUP.fieldNames())
    )


def customer_view(card_member: DataFrame, member_score: DataFrame, tx: DataFrame) -> DataFrame:
    """What support staff see of a cardholder: member data, score, last
    transaction.  Cards without score or transactions stay in the view."""
    last = newest_rows(tx.select("card_id", "amount", "postcode", "transaction_dt", *ORDER), "card_id", ORDER, 1)
    return (
        card_member.join(last.drop("rank", *ORDER), "card_id", "left")
        .join(member_score, "member_id", "left")
    )


def live_view(card_member: DataFrame, member_score: DataFrame, decisions: DataFrame, lookup: DataFrame) -> DataFrame:
    """What support staff see while transactions come in: member data, score,
    the limit and last genuine place of the card, its last transaction with
    the verdict and the rules it broke, and how many frauds it had."""
    last = newest_rows(
        decisions.select("card_id", "amount", "postcode", "transaction_dt", "status", "speed_rule", "amount_rule", "score_rule", *ORDER),
        "card_id", ORDER, 1,
    )
    frauds = decisions.groupBy("card_id").agg(F.count(F.when(F.col("status") == "FRAUD", 1)).alias("frauds"))
    place = lookup.select(
        "card_id", "ucl", F.col("postcode").alias("genuine_postcode"), F.col("transaction_dt").alias("genuine_dt")
    )
    return (
        card_member.join(last.drop("rank", *ORDER), "card_id", "left")
        .join(frauds, "card_id", "left")
        .join(place, "card_id", "left")
        .join(member_score, "member_id", "left")
        .withColumn("frauds", F.coalesce("frauds", F.lit(0)))
    )


# --- the three rules ---------------------------------------------------------


def zip_places(zips: DataFrame) -> DataFrame:
    """``(postcode, lat, lon)``; two rows for one zip are an error, since no
    order of rows could say which one holds."""
    once = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("duplicate zip "), F.col("zip")))
    )
    return (
        zips.groupBy("zip")
        .agg(F.max("lat").alias("lat"), F.max("lon").alias("lon"), once.cast("string").alias("_dup"))
        .filter("_dup is null")
        # Half a place is none.
        .select(
            F.col("zip").alias("postcode"),
            F.when(F.col("lon").isNotNull(), F.col("lat")).alias("lat"),
            F.when(F.col("lat").isNotNull(), F.col("lon")).alias("lon"),
        )
    )


class Places:
    """The coordinates of postcodes, with their size checked once.  A job that
    scores many batches makes one and hands it to each."""

    def __init__(self, zips: DataFrame):
        self.table = zip_places(zips)
        self.small = is_small(self.table)

    @classmethod
    def of(cls, zips: DataFrame | Places) -> Places:
        return zips if isinstance(zips, cls) else cls(zips)

    def locate(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Add the coordinates of ``postcode`` (null where it is unknown)."""
        named = self.table.withColumnsRenamed({"lat": prefix + "lat", "lon": prefix + "lon"})
        return dimension_join(df, named, "postcode", "left", small=self.small)


def journeys(tx: DataFrame, lookup: DataFrame, zips: DataFrame) -> DataFrame:
    """Each transaction beside its card's lookup row: kilometres, seconds and
    kilometres per second from the last known place."""
    places = Places.of(zips)
    last = places.locate(lookup.withColumn("_known", F.lit(True)), "last_").withColumnsRenamed(
        {"postcode": "last_postcode", "epoch": "last_epoch", "transaction_dt": "last_dt"}
    )
    both = salted_join(places.locate(tx), last, "card_id", "left", spread_by=["txn_id"])
    km = truncate2(distance_km(F.col("lat"), F.col("lon"), F.col("last_lat"), F.col("last_lon")))
    return both.withColumns({"km": km, "secs": F.abs(F.col("epoch") - F.col("last_epoch"))}).withColumn(
        "speed", F.try_divide("km", "secs")
    )


def apply_rules(tx: DataFrame, lookup: DataFrame, zips: DataFrame) -> DataFrame:
    """The rules of each transaction against the lookup as it stands, without
    moving it."""
    no_card = F.col("_known").isNull() | F.col("ucl").isNull() | F.col("score").isNull()
    unknown = (
        F.when(no_card, "UNKNOWN_CARD")
        .when(F.col("km").isNull(), "UNKNOWN_POSTCODE")
        .when(F.col("amount").isNull(), "UNKNOWN_AMOUNT")
    )
    ruled = journeys(tx, lookup, zips).withColumns(
        {
            "speed_rule": too_fast(F.col("km"), F.col("secs")),
            "amount_rule": F.col("amount") > F.col("ucl"),
            "score_rule": F.col("score") < F.lit(fold.SCORE_FLOOR),
        }
    )
    fraud = F.col("speed_rule") | F.col("amount_rule") | F.col("score_rule")
    status = F.coalesce(unknown, F.when(fraud, "FRAUD").otherwise("GENUINE"))
    return ruled.withColumn("status", status).select(
        *TRANSACTION, "km", "secs", "speed_rule", "amount_rule", "score_rule", "status"
    )


def score_transactions(
    tx: DataFrame,
    lookup: DataFrame,
    zips: DataFrame | Places,
    carry: list[str] = TRANSACTION,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Every transaction with its verdict, where a genuine one moves the card
    to its own place and time and a fraud does not.

    Transactions and lookup rows meet in one shuffle: the lookup row of a card
    sorts before its transactions and the fold picks it up there.
    """
    places = Places.of(zips)
    placed = places.locate(tx).select(*carry, "lat", "lon")
    lookup = places.locate(lookup).select("card_id", "ucl", "score", "lat", "lon", "epoch")
    light, chunks, heavy = split_heavy(placed, "card_id", ORDER, rows_per_task, keys=tx)
    rows = light.withColumn("chunk", F.lit(0))
    starts = lookup.withColumn("chunk", F.lit(0))
    if chunks is not None:
        rows = rows.unionByName(chunks)
        heavy_lookup = checkpointed(lookup.join(F.broadcast(heavy), "card_id"))  # one row per heavy key
        starts = starts.join(F.broadcast(heavy), "card_id", "left_anti").unionByName(
            _chunk_starts(chunks, heavy_lookup)
        )
    both = _with_starts(rows, starts)
    schema = ", ".join(f"`{n}` {placed.schema[n].dataType.simpleString()}" for n in carry)
    return both.mapInArrow(fold.decide(list(carry)), f"{schema}, {fold.DECISION_FIELDS}")


def _with_starts(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows of each ``(card, chunk)`` in one place, its start row first."""
    return (
        rows.withColumn("kind", F.lit(fold.TRANSACTION))
        .unionByName(starts.withColumn("kind", F.lit(fold.START)), allowMissingColumns=True)
        .repartition("card_id", "chunk")
        .sortWithinPartitions("card_id", "chunk", "kind", *ORDER)
    )


def _chunk_starts(chunks: DataFrame, lookup: DataFrame) -> DataFrame:
    """The lookup row each chunk of a heavy card starts from.

    ``lookup`` holds the heavy cards only, so it is broadcast.
    """
    # What cannot be judged moves nothing, like a fraud.
    refused = F.coalesce((F.col("amount") > F.col("ucl")) | (F.col("score") < F.lit(fold.SCORE_FLOOR)), F.lit(True))
    refused = refused | F.col("lat").isNull()
    movable = lookup.filter("lat is not null and ucl is not null and score is not null")
    walk = (
        chunks.select("card_id", "chunk", "amount", "lat", "lon", *ORDER)
        .join(F.broadcast(movable.select("card_id", "ucl", "score")), "card_id")
        .select("card_id", "chunk", *ORDER, "lat", "lon", refused.alias("blocked"))
    )
    first = movable.select("card_id", F.lit(-1).alias("chunk"), "lat", "lon", "epoch")
    true = _strung(walk, first).withColumnsRenamed({"lat": "_lat", "lon": "_lon", "epoch": "_epoch"})
    every = chunks.select("card_id", "chunk").distinct()
    return (
        every.join(F.broadcast(lookup), "card_id")
        .join(true, ["card_id", "chunk"], "left")
        .withColumns({n: F.coalesce("_" + n, n) for n in ("lat", "lon", "epoch")})
        .drop("_lat", "_lon", "_epoch")
    )


def _strung(walk: DataFrame, first: DataFrame) -> DataFrame:
    """The place each chunk of ``walk`` starts from, given each card's own
    start ``first`` (chunk -1).

    A chunk is a map from the place it starts from to the place it ends at.
    All chunks are walked twice, at the same time: once for the rows that they
    can end at, and once from the places that they can start from.  These are
    the ends of the chunk before, those of older chunks that a chunk in between
    may leave alone because it ends before every place can be reached from
    them, and the card's own start.  The maps are then composed in pairs, pairs
    of pairs and so on, so the rounds that follow are as many as the number of
    chunks has binary digits, whatever the places are, and look only at maps.
    A map has as many rows as a chunk has ends, which depends on how many
    places a card is at within a day; the number of chunks is bounded by the
    slots of the cluster.
    """
    at = ["lat", "lon", "epoch"]
    to = ["to_" + n for n in at]
    in_order = Window.partitionBy("card_id").orderBy("chunk")
    reach = F.max(F.when(~F.col("blocked"), F.col("epoch"))).alias("reach")
    chunks = checkpointed(
        walk.groupBy("card_id", "chunk").agg(reach).select(
            "card_id",
            "chunk",
            (F.row_number().over(in_order) - 1).alias("pos"),
            F.max("reach").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        )
    )
    small = F.broadcast(chunks)
    rows = walk.withColumn("kind", F.lit(fold.TRANSACTION)).repartition("card_id", "chunk")
    rows = rows.sortWithinPartitions("card_id", "chunk", *ORDER)
    ends = rows.mapInArrow(fold.ends, fold.ENDS_SCHEMA).join(small.select("card_id", "chunk", "pos"), ["card_id", "chunk"])
    after = chunks.select("card_id", F.col("chunk").alias("_chunk"), F.col("pos").alias("_pos"), "before")
    leads = (F.col("_pos") == F.col("pos") + 1) | (
        (F.col("_pos") > F.col("pos")) & (F.coalesce("before", F.col("epoch")) < F.col("epoch") + fold.HORIZON)
    )
    passed = ends.join(F.broadcast(after), "card_id").filter(leads).select("card_id", F.col("_chunk").alias("chunk"), *at)
    own = first.drop("chunk").join(small.select("card_id", "chunk"), "card_id").select("card_id", "chunk", *at)
    starts = checkpointed(passed.unionAll(own).distinct())
    walked = _with_starts(walk, starts).mapInArrow(fold.steps, fold.STEP_SCHEMA)
    jump = walked.join(small.select("card_id", "chunk", "pos"), ["card_id", "chunk"])
    jump = checkpointed(jump.select("card_id", "pos", *at, (F.col("pos") + 1).alias("to_pos"), *to))
    true = first.select("card_id", F.lit(0).alias("pos"), *at)
    rounds = (chunks.agg(F.max("pos")).first()[0] or 0).bit_length()
    for turn in range(rounds):
        step = true.join(jump, ["card_id", "pos", *at]).select("card_id", F.col("to_pos").alias("pos"), *[F.col("to_" + n).alias(n) for n in at])
        true = checkpointed(true.unionAll(step).distinct())
        if turn == rounds - 1:
            break
        onward = jump.select(
            "card_id", F.col("pos").alias("to_pos"), *[F.col(n).alias("to_" + n) for n in at],
            F.col("to_pos").alias("_pos"), *[F.col(n).alias("_" + n) for n in to],
        )
        both = jump.join(onward, ["card_id", "to_pos", *to])
        jump = checkpointed(both.select("card_id", "pos", *at, F.col("_pos").alias("to_pos"), *[F.col("_" + n).alias(n) for n in to]))
    return true.join(small.select("card_id", "chunk", "pos"), ["card_id", "pos"]).select("card_id", "chunk", *at)


def closing_places(decisions: DataFrame) -> DataFrame:
    """Where each card stands afterwards: its newest genuine transaction."""
    genuine = decisions.filter(F.col("status") == "GENUINE")
    return latest_location(genuine)


def move_lookup(lookup: DataFrame, moves: DataFrame) -> DataFrame:
    """The lookup with place and time taken from ``moves``; limit and score
    stay as they are."""
    moved = moves.select("card_id", *[F.col(n).alias("_" + n) for n in ("postcode", "transaction_dt", "epoch")])
    went = F.col("_epoch").isNotNull()
    return lookup.join(moved, "card_id", "left").select(
        "card_id",
        "ucl",
        "score",
        *[F.when(went, F.col("_" + n)).otherwise(F.col(n)).alias(n) for n in ("postcode", "transaction_dt", "epoch")],
    )


def cards_in(tx: DataFrame, lookup: DataFrame) -> DataFrame:
    """The lookup rows a batch can need; a batch with few cards spares the
    rest of the lookup the shuffle."""
    cards = tx.select("card_id").distinct()
    return lookup.join(F.broadcast(cards), "card_id", "left_semi") if is_small(cards) else lookup
