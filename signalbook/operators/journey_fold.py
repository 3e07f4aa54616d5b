"""The part of fraud scoring that depends on its own earlier verdicts.

A transaction is compared with the card's last *genuine* one, so the verdicts
of a card form a chain.  The functions here walk rows that Spark has already
partitioned by ``(card_id, chunk)`` and sorted; they hold one Arrow batch and
one card's state at a time, never a whole card.

A place in time is ``(sin lat, cos lat, lon, epoch, lat)``.
"""

from __future__ import annotations

import sys
from itertools import chain
from math import acos, ceil, cos, floor, nan, pi, sin

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from signalbook.functions.geo import KM_PER_MILE, MINUTES_PER_DEGREE, SPEED_LIMIT, STATUTE_PER_NAUTICAL

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCORE_FLOOR = 200.0  # fixed value: lower credit scores are refused

START, TRANSACTION = 0, 1  # kinds of row: where a chunk starts from, what it holds


def place(lat, lon, epoch):
    rad = lat * pi / 180.0
    return (sin(rad), cos(rad), lon, epoch, lat)


def journey(a, b):
    """``(km, secs, impossible)`` of going from ``a`` to ``b``."""
    c = a[0] * b[0] + a[1] * b[1] * cos((a[2] - b[2]) * pi / 180.0)
    arc = acos(-1.0 if c < -1.0 else 1.0 if c > 1.0 else c)
    d = arc * 180.0 / pi * MINUTES_PER_DEGREE * STATUTE_PER_NAUTICAL * KM_PER_MILE
    # Cut to the greatest number of hundredths that is not above d.
    k = floor(d * 100.0)
    if (k + 1) / 100.0 <= d:
        k += 1
    elif k / 100.0 > d:
        k -= 1
    km = k / 100.0
    secs = abs(b[3] - a[3])
    return km, secs, (km / secs >= SPEED_LIMIT if secs else km > 0)


DECIDE_INPUT = ["card_id", "chunk", "kind", "epoch", "lat", "lon", "amount", "ucl", "score"]

DECISION_FIELDS = (
    "km double, secs bigint, speed_rule boolean, amount_rule boolean, score_rule boolean, status string"
)
_DECISION_TYPES = [pa.float64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
_DECISION_NAMES = ["km", "secs", "speed_rule", "amount_rule", "score_rule", "status"]


def _floats(batch, name):
    return batch.column(name).to_numpy(zero_copy_only=False).astype("float64")  # null -> NaN


def decide(keep):
    """A ``mapInArrow`` function: rows in, columns ``keep`` and the verdict
    out, for every transaction."""

    def run(batches):
        key = at = None
        ucl, score = nan, nan
        for batch in batches:
            lat = _floats(batch, "lat")
            starts = batch.column("kind").to_numpy() == START
            columns = (
                zip(batch.column("card_id").to_pylist(), batch.column("chunk").to_numpy().tolist(), strict=True),
                starts.tolist(),
                np.sin(lat * pi / 180.0).tolist(),
                np.cos(lat * pi / 180.0).tolist(),
                _floats(batch, "lon").tolist(),
                batch.column("epoch").to_numpy().tolist(),
                lat.tolist(),
                _floats(batch, "amount").tolist(),
                _floats(batch, "ucl").tolist(),
                _floats(batch, "score").tolist(),
            )
            verdicts = []
            for card, is_start, sine, cosine, lon, epoch, la, amount, limit, points in zip(*columns, strict=True):
                if is_start:
                    key, ucl, score = card, limit, points
                    at = (sine, cosine, lon, epoch, la) if la == la else None
                    continue
                if key != card:  # no start row: the lookup lacks the card
                    key, at, ucl = card, None, nan
                if ucl != ucl or score != score:
                    verdicts.append((None, None, None, None, None, "UNKNOWN_CARD"))
                    continue
                over, poor = (amount > ucl if amount == amount else None), score < SCORE_FLOOR
                if at is None or la != la:
                    verdicts.append((None, None, None, over, poor, "UNKNOWN_POSTCODE"))
                    continue
                here = (sine, cosine, lon, epoch, la)
                km, secs, fast = journey(at, here)
                if over is None:
                    verdicts.append((km, secs, fast, over, poor, "UNKNOWN_AMOUNT"))
                elif fast or over or poor:
                    verdicts.append((km, secs, fast, over, poor, "FRAUD"))
                else:
                    verdicts.append((km, secs, fast, over, poor, "GENUINE"))
                    at = here
            if verdicts:
                kept = batch.select(keep).filter(pa.array(~starts))
                found = zip(zip(*verdicts, strict=True), _DECISION_TYPES, strict=True)
                yield pa.RecordBatch.from_arrays(
                    kept.columns + [pa.array(c, t) for c, t in found], names=keep + _DECISION_NAMES
                )

    return run


# A heavy card is cut into chunks that are walked at the same time, although
# a chunk's verdicts depend on the place its predecessor ends at.  A place that
# a chunk can end at is one of its own rows or the place it started from; so
# the rows that are ends are found first, then where each chunk leads from the
# ends before it, and these maps are strung together.  Two walks become one
# at the first row that can be reached from both.

#: After so many seconds every place can be reached from every other.
HORIZON = ceil(180.0 * MINUTES_PER_DEGREE * STATUTE_PER_NAUTICAL * KM_PER_MILE / SPEED_LIMIT) + 1

ENDS_SCHEMA = "card_id string, chunk int, lat double, lon double, epoch bigint"
STEP_SCHEMA = ENDS_SCHEMA + ", to_lat double, to_lon double, to_epoch bigint"

WALK_INPUT = ["card_id", "chunk", "kind", "epoch", "lat", "lon", "blocked"]
_ENDS = [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]

#: Kilometres by which two ways of computing a distance differ at most.
_DOUBT = 1e-4


class _Open:
    """Places that no later row could be reached from yet."""

    def __init__(self):
        self.at = np.zeros((16, 5))
        self.n = 0

    def meet(self, here):
        """Drops the places that ``here`` can be reached from, and adds it.
        Where the limit is near, the exact journey decides."""
        at = self.at[: self.n]
        c = at[:, 0] * here[0] + at[:, 1] * here[1] * np.cos((at[:, 2] - here[2]) * pi / 180.0)
        km = np.arccos(np.clip(c, -1.0, 1.0)) * 180.0 / pi * MINUTES_PER_DEGREE * STATUTE_PER_NAUTICAL * KM_PER_MILE
        limit = SPEED_LIMIT * np.abs(here[3] - at[:, 3])
        stay = km - 0.01 - _DOUBT > limit
        for i in np.flatnonzero(~stay & (km + _DOUBT >= limit)).tolist():
            one = at[i].tolist()
            stay[i] = journey((*one[:3], int(one[3]), one[4]), here)[2]
        kept = at[stay]
        if len(kept) == len(self.at):
            self.at = np.vstack([self.at, np.zeros_like(self.at)])
        self.at[: len(kept)] = kept
        self.at[len(kept)] = here
        self.n = len(kept) + 1

    def rows(self, key):
        return [(*key, p[4], p[2], int(p[3])) for p in self.at[: self.n].tolist()]


def ends(batches):
    """The rows of each chunk that it can end at, wherever it starts."""
    key, held = None, _Open()

    def found():
        columns = zip(zip(*held.rows(key), strict=True), _ENDS, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["card_id", "chunk", "lat", "lon", "epoch"])

    rows = (zip(*(b.column(n).to_pylist() for n in WALK_INPUT), strict=True) for b in batches)
    for card, chunk, _kind, epoch, lat, lon, blocked in chain.from_iterable(rows):
        if key != (card, chunk):
            if held.n:
                yield found()
            key, held = (card, chunk), _Open()
        if not blocked:
            held.meet(place(lat, lon, epoch))
    if held.n:
        yield found()


def steps(batches):
    """Where each chunk ends, for each place it is said to start from."""
    names = ["card_id", "chunk", "lat", "lon", "epoch", "to_lat", "to_lon", "to_epoch"]
    types = _ENDS + _ENDS[2:]

    def found(key, held):
        rows = [(*key, s[4], s[2], s[3], p[4], p[2], p[3]) for p, starts in held.items() for s in starts]
        columns = zip(zip(*rows, strict=True), types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

    key, held = None, {}
    rows = (zip(*(b.column(n).to_pylist() for n in WALK_INPUT), strict=True) for b in batches)
    for card, chunk, kind, epoch, lat, lon, blocked in chain.from_iterable(rows):
        if key != (card, chunk):
            if held:
                yield found(key, held)
            key, held = (card, chunk), {}
        if kind == START:
            start = place(lat, lon, epoch)
            held.setdefault(start, []).append(start)
        elif not blocked and held:
            here = place(lat, lon, epoch)
            moved = [p for p in held if not journey(p, here)[2]]
            if moved:
                held.setdefault(here, [])
                for p in moved:
                    if p != here:
                        held[here] += held.pop(p)
    if held:
        yield found(key, held)
