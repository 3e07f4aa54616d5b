"""The rules, the fold, and its split over chunks."""

import json
import math
import random
from decimal import ROUND_DOWN, Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from signalbook import schemas
from signalbook.functions.geo import distance_km, too_fast, truncate2
from signalbook.operators import journey_fold as fold
from signalbook.operators import skew
from signalbook.plans import fraud

ZIPS = {"A": (0.0, 0.0), "B": (0.0, 10.0), "C": (45.0, 45.0), "D": (0.0, 0.05)}
T0 = 1_700_000_000


def zips(spark, extra=()):
    rows = [(z, *p, None, None, None) for z, p in ZIPS.items()] + list(extra)
    return spark.createDataFrame(rows, schemas.ZIPS)


def tx(spark, rows):
    """Rows of (txn_id, card, amount, postcode, epoch)."""
    full = [(i, c, "m" + c, a, p, "pos", str(e), e) for i, c, a, p, e in rows]
    schema = (
        "txn_id bigint, card_id string, member_id string, amount int, postcode string, "
        "pos_id string, transaction_dt string, epoch bigint"
    )
    return spark.createDataFrame(full, schema)


def lookup(spark, rows):
    """Rows of (card, ucl, score, postcode, epoch)."""
    return spark.createDataFrame([(c, u, s, p, str(e), e) for c, u, s, p, e in rows], schemas.LOOKUP)


def km_between(p, q):
    (a, b), (c, d) = ZIPS[p], ZIPS[q]
    cosine = math.sin(math.radians(a)) * math.sin(math.radians(c)) + math.cos(math.radians(a)) * math.cos(
        math.radians(c)
    ) * math.cos(math.radians(b - d))
    km = math.degrees(math.acos(max(-1.0, min(1.0, cosine)))) * 60 * 1.1515 * 1.609344
    return float(Decimal(repr(km)).quantize(Decimal("0.01"), ROUND_DOWN))


def brute_force(rows, state):
    """Verdicts by a plain walk over sorted rows."""
    out, at = {}, {c: (p, e) for c, _u, _s, p, e in state}
    rules = {c: (u, s) for c, u, s, _p, _e in state}
    for i, card, amount, post, epoch in sorted(rows, key=lambda r: (r[4], r[0])):
        if card not in rules:
            out[i] = "UNKNOWN_CARD"
            continue
        place, since = at[card]
        if place not in ZIPS or post not in ZIPS:
            out[i] = "UNKNOWN_POSTCODE"
            continue
        km, secs = km_between(place, post), abs(epoch - since)
        fast = km / secs >= 0.25 if secs else km > 0
        ucl, score = rules[card]
        if fast or amount > ucl or score < 200:
            out[i] = "FRAUD"
        else:
            out[i] = "GENUINE"
            at[card] = (post, epoch)
    return out


def verdicts(df):
    return {r.txn_id: r.status for r in df.select("txn_id", "status").collect()}


CASES = [
    # name, amount, postcode, epoch, ucl, score, expected
    ("same place, no time", 10, "A", T0, 100.0, 300.0, "GENUINE"),
    ("other place, no time", 10, "B", T0, 100.0, 300.0, "FRAUD"),
    ("slow journey", 10, "B", T0 + 4448, 100.0, 300.0, "GENUINE"),
    ("fast journey", 10, "B", T0 + 4446, 100.0, 300.0, "FRAUD"),
    ("amount at the limit", 100, "A", T0 + 9, 100.0, 300.0, "GENUINE"),
    ("amount above the limit", 101, "A", T0 + 9, 100.0, 300.0, "FRAUD"),
    ("score at the floor", 10, "A", T0 + 9, 100.0, 200.0, "GENUINE"),
    ("score below the floor", 10, "A", T0 + 9, 100.0, 199.0, "FRAUD"),
    ("earlier than the state, near in time", 10, "B", T0 - 100, 100.0, 300.0, "FRAUD"),
    ("earlier than the state, far in time", 10, "B", T0 - 9000, 100.0, 300.0, "GENUINE"),
    ("place not in the dimension", 10, "Z", T0 + 9, 100.0, 300.0, "UNKNOWN_POSTCODE"),
]


def test_hand_made_cases_in_both_scorers(spark):
    rows = [(i, f"c{i}", a, p, e) for i, (_n, a, p, e, _u, _s, _x) in enumerate(CASES)]
    state = [(f"c{i}", u, s, "A", T0) for i, (_n, _a, _p, _e, u, s, _x) in enumerate(CASES)]
    rows.append((99, "nobody", 1, "A", T0))
    expected = {i: c[-1] for i, c in enumerate(CASES)} | {99: "UNKNOWN_CARD"}
    args = tx(spark, rows), lookup(spark, state), zips(spark)
    assert verdicts(fraud.score_transactions(*args)) == expected
    assert verdicts(fraud.apply_rules(*args)) == expected
    assert brute_force(rows, state) == expected


@pytest.mark.parametrize("per_task", [None, 3])
def test_what_is_missing_is_unknown_in_all_scorers(spark, per_task):
    cases = [(None, 100.0, 300.0, "UNKNOWN_AMOUNT"), (1, None, 300.0, "UNKNOWN_CARD"), (1, 100.0, None, "UNKNOWN_CARD")]
    rows, state, expected = [], [], {}
    for c, (amount, ucl, score, status) in enumerate(cases):
        state.append((f"c{c}", ucl, score, "A", T0))
        for k in range(12):  # enough to be cut into chunks
            rows.append((100 * c + k, f"c{c}", amount, "A", T0 + 9 * k))
            expected[100 * c + k] = status
    args = tx(spark, rows), lookup(spark, state), zips(spark)
    assert verdicts(fraud.score_transactions(*args, rows_per_task=per_task)) == expected
    assert verdicts(fraud.apply_rules(*args)) == expected


@pytest.mark.parametrize("per_task", [None, 3])
def test_half_a_place_is_none(spark, per_task):
    rows = [(k, "c", 1, "H", T0 + 9 * k) for k in range(9)]
    args = tx(spark, rows), lookup(spark, [("c", 100.0, 300.0, "A", T0)]), zips(spark, [("H", 1.0, None, None, None, None)])
    assert set(verdicts(fraud.score_transactions(*args, rows_per_task=per_task)).values()) == {"UNKNOWN_POSTCODE"}
    assert set(verdicts(fraud.apply_rules(*args)).values()) == {"UNKNOWN_POSTCODE"}


def test_speed_limit_is_inclusive(spark):
    exact = spark.range(1).select(
        too_fast(F.lit(0.25), F.lit(1)).alias("at"),
        too_fast(F.lit(0.2499), F.lit(1)).alias("below"),
        too_fast(F.lit(0.0), F.lit(0)).alias("nowhere"),
    )
    assert exact.first() == Row(at=True, below=False, nowhere=False)


def test_fraud_does_not_move_the_card(spark):
    rows = [
        (1, "c", 10, "B", T0 + 60),  # impossible from A
        (2, "c", 10, "A", T0 + 120),  # fine from A, impossible from B
        (3, "c", 500, "B", T0 + 90_000),  # too much money, far enough in time
        (4, "c", 10, "A", T0 + 90_001),  # so the card is still at A
    ]
    args = tx(spark, rows), lookup(spark, [("c", 100.0, 300.0, "A", T0)]), zips(spark)
    expected = {1: "FRAUD", 2: "GENUINE", 3: "FRAUD", 4: "GENUINE"}
    assert verdicts(fraud.score_transactions(*args)) == expected
    closing = fraud.closing_places(fraud.score_transactions(*args)).collect()
    assert [(r.card_id, r.postcode, r.epoch) for r in closing] == [("c", "A", T0 + 90_001)]


def test_lookup_keeps_limit_and_score(spark):
    before = lookup(spark, [("c", 100.0, 300.0, "A", T0), ("d", 5.0, 250.0, "B", T0)])
    moves = spark.createDataFrame([("c", "B", "x", T0 + 5)], schemas.MOVES)
    after = {r.card_id: (r.ucl, r.score, r.postcode, r.epoch) for r in fraud.move_lookup(before, moves).collect()}
    assert after == {"c": (100.0, 300.0, "B", T0 + 5), "d": (5.0, 250.0, "B", T0)}


def test_lookup_place_without_coordinates(spark):
    rows = [(1, "c", 10, "A", T0 + 60), (2, "c", 10, "A", T0 + 600)]
    args = tx(spark, rows), lookup(spark, [("c", 100.0, 300.0, "Q", T0)]), zips(spark)
    for per_task in (1, 100):
        got = verdicts(fraud.score_transactions(*args, rows_per_task=per_task))
        assert got == {1: "UNKNOWN_POSTCODE", 2: "UNKNOWN_POSTCODE"}


def test_duplicate_zip_is_an_error(spark):
    twice = zips(spark, [("A", 1.0, 1.0, None, None, None)])
    args = tx(spark, [(1, "c", 1, "A", T0)]), lookup(spark, [("c", 1.0, 300.0, "A", T0)]), twice
    with pytest.raises(Exception, match="duplicate zip A"):
        fraud.score_transactions(*args).collect()


def random_walk(seed, cards, n, span):
    rng = random.Random(seed)
    places = [*ZIPS, "Q"] if seed % 2 else list(ZIPS)
    weights = [0.6] + [0.4 / (cards - 1)] * (cards - 1)
    rows = [
        (
            i,
            f"c{rng.choices(range(cards), weights)[0]}",
            rng.choice([10, 10, 10, 500]),
            rng.choice(places),
            T0 + rng.randrange(span),
        )
        for i in range(n)
    ]
    state = [
        (f"c{c}", 100.0, rng.choice([300.0, 300.0, 300.0, 100.0]) if c else 300.0, rng.choice(list(ZIPS)),
         T0 + rng.choice([-1000, 0, span // 2]))
        for c in range(cards - 1)
    ]
    return rows, state


@pytest.mark.parametrize(("seed", "span"), [(1, 4_000), (2, 50_000), (3, 400_000), (4, 600), (5, 2_000_000)])
@pytest.mark.parametrize("per_task", [10_000, 23, 3])
def test_split_cards_give_the_plain_walk(spark, seed, span, per_task):
    rows, state = random_walk(seed, 5, 160, span)
    df = tx(spark, rows).repartition(3)
    got = verdicts(fraud.score_transactions(df, lookup(spark, state), zips(spark), rows_per_task=per_task))
    assert got == brute_force(rows, state)


def test_one_row_per_chunk(spark, monkeypatch):
    monkeypatch.setattr(skew, "CHUNKS_PER_SLOT", 1000)
    rows, state = random_walk(6, 3, 60, 9_000)
    args = tx(spark, rows), lookup(spark, state), zips(spark)
    assert verdicts(fraud.score_transactions(*args, rows_per_task=1)) == brute_force(rows, state)


def test_two_places_in_turn_never_merge(spark):
    """Walks from A and from B stay apart for ever; the split must still find
    the one that is real."""
    rows = [(i, "c", 10, "AB"[i % 2], T0 + 60 * i) for i in range(200)]
    for home in "AB":
        state = [("c", 100.0, 300.0, home, T0 - 10)]
        got = verdicts(
            fraud.score_transactions(tx(spark, rows), lookup(spark, state), zips(spark), rows_per_task=9)
        )
        assert got == brute_force(rows, state)


def test_many_places_take_few_rounds(spark, monkeypatch):
    """A card with 2,000 places: far more than a chunk is walked from."""
    rng = random.Random(11)
    grid = [(f"p{i}", rng.uniform(-60, 60), rng.uniform(-170, 170), None, None, None) for i in range(2_000)]
    rows = [(i, "c", 10, rng.choice(grid)[0], T0 + 600 * i + rng.randrange(600)) for i in range(20_000)]
    args = tx(spark, rows).repartition(4), lookup(spark, [("c", 100.0, 300.0, "p0", T0)]), zips(spark, grid)
    plain = verdicts(fraud.score_transactions(*args))
    walks = []
    with_starts = fraud._with_starts
    monkeypatch.setattr(fraud, "_with_starts", lambda r, s: walks.append(s.count()) or with_starts(r, s))
    assert verdicts(fraud.score_transactions(*args, rows_per_task=1_000)) == plain
    assert {"FRAUD", "GENUINE"} == set(plain.values())
    # One walk from all starts and one, for the verdicts, from the true ones.
    assert len(walks) == 2 and max(walks) <= 100 * skew.CHUNKS_PER_SLOT * 8


def test_regions_in_turn_take_logarithmic_rounds(spark, monkeypatch):
    """Several walks that never meet, with the one that is real seldom the newest."""
    rows = [(i, "c", 10, "ABBB"[i % 4], T0 + 60 * i) for i in range(240)]
    state = [("c", 100.0, 300.0, "A", T0 - 10)]
    kept = []
    monkeypatch.setattr(fraud, "checkpointed", lambda df, real=fraud.checkpointed: kept.append(0) or real(df))
    got = verdicts(fraud.score_transactions(tx(spark, rows), lookup(spark, state), zips(spark), rows_per_task=9))
    assert got == brute_force(rows, state)
    # The lookup of heavy cards, chunks, starts and maps; then two tables a round, for 27 chunks.
    assert 4 < len(kept) <= 4 + 2 * 5


def test_chunks_that_leave_a_place_alone(spark):
    """Long runs that cannot be reached from the last genuine place, and runs
    that are all blocked: the place passes through many chunks."""
    for seed, per_task in ((0, 3), (3, 11)):
        rng = random.Random(seed)
        rows, at = [], T0
        while len(rows) < 300:
            here, amount = rng.choice("ABC"), rng.choice([10, 10, 1_000])
            for _ in range(rng.choice([1, 2, 40])):
                at += rng.choice([1, 30, 900])
                rows.append((len(rows), "c", amount, here, at))
            at += rng.choice([0, 0, 50_000, 100_000])
        state = [("c", 100.0, 300.0, "A", T0 + rng.choice([-10, 5, 200_000]))]
        expected = brute_force(rows, state)
        args = tx(spark, rows).repartition(3), lookup(spark, state), zips(spark)
        assert verdicts(fraud.score_transactions(*args, rows_per_task=per_task)) == expected


def test_split_rolling_stats(spark):
    rows, _ = random_walk(7, 4, 300, 5_000)
    df = tx(spark, rows)
    plain = {tuple(r) for r in fraud.rolling_stats(df).collect()}
    assert len(plain) == 300
    for per_task in (1, 4, 40):
        assert {tuple(r) for r in fraud.rolling_stats(df.repartition(5), rows_per_task=per_task).collect()} == plain


def test_single_row_has_a_limit(spark):
    stats = fraud.last_n_stats(tx(spark, [(1, "c", 70, "A", T0)])).first()
    assert (stats.n, stats.moving_avg, stats.moving_std, stats.ucl) == (1, 70.0, 0.0, 70.0)


def test_last_ten_by_time_then_id(spark):
    rows = [(i, "c", i, "A", T0 + i // 3) for i in range(30)]
    stats = fraud.last_n_stats(tx(spark, rows).repartition(7), k=2.0).first()
    newest = list(range(20, 30))
    mean = sum(newest) / 10
    dev = math.sqrt(sum((x - mean) ** 2 for x in newest) / 10)
    assert stats.moving_avg == mean
    assert stats.ucl == pytest.approx(mean + 2 * dev)
    assert stats.epoch == T0 + 9


def test_only_genuine_history(spark):
    rows = tx(spark, [(1, "1", 10, "A", T0), (2, "1", 900, "B", T0 + 1)])
    marked = rows.withColumn("status", F.when(F.col("txn_id") == 2, "FRAUD").otherwise("GENUINE"))
    members = spark.createDataFrame([("1", "m1")], "card_id string, member_id string")
    scores = spark.createDataFrame([("m1", 250.0)], schemas.MEMBER_SCORE)
    got = fraud.build_lookup(marked, members, scores, only_genuine=True).first()
    assert (got.ucl, got.postcode, got.score) == (10.0, "A", 250.0)


def payload(**change):
    good = {
        "card_id": "1", "member_id": "2", "amount": 33, "postcode": "A", "pos_id": "9",
        "transaction_dt": "21-01-2024 10:20:30",
    }
    return json.dumps({k: v for k, v in {**good, **change}.items() if v is not None})


def test_bad_records_are_set_aside(spark):
    values = {
        1: payload(),
        2: '{"card_id": ',
        3: payload(amount=12.5),
        4: payload(transaction_dt="2024-01-21 10:20:30"),
        5: payload(postcode=None),
        6: payload(amount="x"),
        7: payload(transaction_dt="32-01-2024 10:20:30"),
        8: None,
    }
    raw = spark.createDataFrame(list(values.items()), "txn_id bigint, value string")
    parsed = fraud.parse_payloads(raw)
    faults = {r.txn_id: r.reason for r in fraud.quarantined(parsed).collect()}
    assert faults == {
        2: "MALFORMED_JSON",
        3: "BAD_AMOUNT",
        4: "BAD_DATE",
        5: "MISSING_FIELD",
        6: "BAD_AMOUNT",
        7: "BAD_DATE",
        8: "MALFORMED_JSON",
    }
    good = fraud.accepted(parsed).collect()
    assert [(r.txn_id, r.amount, r.epoch) for r in good] == [(1, 33, 1705832430)]


def test_truncation_and_clamp_in_columns(spark):
    df = spark.createDataFrame([(1.13,), (1.12999999999999,), (0.0,), (20014.129,)], "x double")
    assert [r.t for r in df.select(truncate2(F.col("x")).alias("t")).collect()] == [1.13, 1.12, 0.0, 20014.12]
    same = spark.createDataFrame([(a / 7.0, a / 3.0) for a in range(-600, 600)], "lat double, lon double")
    here = distance_km(F.col("lat"), F.col("lon"), F.col("lat"), F.col("lon"))
    assert same.filter(F.isnan(here) | (truncate2(here) > 0)).count() == 0


coordinate = st.tuples(st.floats(-89, 89), st.floats(-180, 180))


@given(coordinate, coordinate, st.integers(0, 10**6))
def test_fold_journey_cuts_like_decimal_text(p, q, secs):
    a, b = fold.place(*p, 0), fold.place(*q, secs)
    km, took, fast = fold.journey(a, b)
    c = a[0] * b[0] + a[1] * b[1] * math.cos((a[2] - b[2]) * math.pi / 180.0)
    exact = math.acos(max(-1.0, min(1.0, c))) * 180.0 / math.pi * 60.0 * 1.1515 * 1.609344
    assert km == float(Decimal(repr(exact)).quantize(Decimal("0.01"), ROUND_DOWN))
    assert took == secs
    assert fast == (km / secs >= 0.25 if secs else km > 0)
    assert fold.journey(b, a)[0] == km
