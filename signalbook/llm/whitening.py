"""Whitening of embeddings on their leading principal axes, by spectrum slicing.

The covariance comes out of two passes in whole numbers, so it is the same
however the rows are spread.  It has the size of the dimension, and only it
reaches the driver.  There a factorisation L D L' of the matrix less a shift
has as many positive pivots as there are eigenvalues above the shift; halving
by these counts isolates each leading eigenvalue, Rayleigh quotient iteration
finds it with its vector, and two more counts certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.llm.hard_negatives import exact, filled, finite, matrix, whole
from signalbook.llm.store import stored

COMPONENTS = 4
#: Whole numbers of any size travel as three parts of so many bits.
_PART = 50
_EPS = float(np.finfo(float).eps)


def _parts(values: list[int]) -> list[pa.Array]:
    mask = (1 << _PART) - 1
    parts = [[v & mask for v in values], [v >> _PART & mask for v in values], [v >> 2 * _PART for v in values]]
    return [pa.array([p], pa.list_(pa.int64())) for p in parts]


def _sums(centre: list[int] | None):
    """A ``mapInArrow`` function: the sums of a task's vectors as row -1, and,
    given a centre, of the products of their differences from it, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = None, None
        for batch in batches:
            x = matrix(batch.column("x"))
            if not len(x):
                continue
            if centre is not None:
                x = x.astype(object) - np.array(centre, object) if exact(x, x) is object else x - np.array(centre)
            x = x.astype(kind) if (kind := exact(x, x)) is not object else x
            # Sums of so many rows at a time are exact too.
            step = len(x) if kind is object else max(1, (1 << 53 if kind is np.float64 else 1 << 62) // max(1, int(np.abs(x).max(initial=1)) ** 2))
            for at in range(0, len(x), step):
                some = x[at : at + step]
                sums = np.array([int(v) for v in some.sum(axis=0)], object)
                total = sums if total is None else total + sums
                if centre is not None:
                    new = (some.T @ some).astype(np.int64 if kind is not object else object).astype(object)
                    products = new if products is None else products + new
        rows = [] if total is None else [(-1, total), *enumerate([] if products is None else products)]
        for i, values in rows:
            yield pa.record_batch([pa.array([i], pa.int32()), *_parts(values.tolist())], names=["i", "a", "b", "c"])

    return run


def _added(vectors: DataFrame, centre: list[int] | None) -> dict[tuple[int, int], int]:
    """The sums over all tasks, by row and column."""
    parts = vectors.mapInArrow(_sums(centre), "i int, a array<long>, b array<long>, c array<long>")
    cells = parts.select("i", F.posexplode(F.arrays_zip("a", "b", "c")).alias("j", "v"))
    sums = [F.sum(F.col(f"v.{p}").cast("decimal(38,0)")).alias(p) for p in "abc"]
    rows = cells.groupBy("i", "j").agg(*sums).collect()
    return {(r.i, r.j): int(r.a) + (int(r.b) << _PART) + (int(r.c) << 2 * _PART) for r in rows}


def above(matrix_: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``: the
    positive pivots of L D L', with pivots of one or two rows."""
    m = matrix_ - shift * np.eye(len(matrix_))
    count, alpha = 0, (1 + sqrt(17)) / 8
    while len(m):
        size = np.abs(m)
        p = int(np.argmax(size.diagonal()))
        i, j = divmod(int(np.argmax(size)), len(m))
        if size[i, j] == 0:
            break
        if size[p, p] >= alpha * size[i, j]:
            rest = np.delete(np.arange(len(m)), p)
            count += bool(m[p, p] > 0)
            m = m[np.ix_(rest, rest)] - np.outer(m[rest, p], m[rest, p] / m[p, p])
        else:
            # The determinant of this pair is negative: one pivot of each sign.
            rest = np.delete(np.arange(len(m)), [i, j])
            count += 1
            sides = m[np.ix_(rest, [i, j])]
            m = m[np.ix_(rest, rest)] - sides @ np.linalg.solve(m[np.ix_([i, j], [i, j])], sides.T)
    return count


def _solved(m: np.ndarray, shift: float, v: np.ndarray, scale: float) -> np.ndarray:
    for nudge in (0.0, 1.0, 8.0):
        try:
            w = np.linalg.solve(m - (shift + nudge * _EPS * scale) * np.eye(len(m)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(w).all() and w.any():
            return w
    return v


def leading(m: np.ndarray, k: int) -> list[tuple[float, np.ndarray]]:
    """The ``k`` largest eigenvalues of a covariance, falling, each with a unit
    vector; fewer if the others are zero to double precision.  Equal ones get
    any orthonormal vectors of their space."""
    scale = float(np.trace(m))
    counts = {scale * (1 + 4 * len(m) * _EPS): 0, -scale: len(m)}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(m, shift)
        return counts[shift]

    found: list[tuple[float, np.ndarray]] = []
    least = 4 * _EPS * scale
    for number in range(1, min(k, len(m)) + 1):
        if scale <= 0 or count(len(m) * least) < number:
            break
        done = np.array([v for _, v in found]).reshape(-1, len(m))
        free = lambda w: w - done.T @ (done @ w)  # noqa: E731, B023
        while True:
            low = max(s for s, c in counts.items() if c >= number)
            high = min(s for s, c in counts.items() if c < number and s > low)
            alone = count(low) == number and count(high) == number - 1
            middle = (low + high) / 2
            if not alone and high - low > least and low < middle < high:
                count(middle)
                continue
            v = free(np.random.default_rng(number).standard_normal(len(m)))
            value = middle
            for turn in range(40):
                # Two steps at a fixed shift, then with the quotient as the shift.
                w = free(_solved(m, middle if turn < 2 else value, v, scale))
                v = free(w / np.linalg.norm(w))
                v /= np.linalg.norm(v)
                value = float(v @ m @ v)
                if turn > 1 and np.linalg.norm(m @ v - value * v) <= least:
                    break
            # The counts beside it say whether this is the one looked for.
            slack = max(2 * least, 2 * float(np.linalg.norm(m @ v - value * v)))
            if count(value - slack) >= number and count(value + slack) < number:
                found.append((value, v))
                break
            if high - low <= least or not low < middle < high:
                raise ArithmeticError(f"eigenvalue {number} could not be certified")
            count(middle)
    return found


@dataclass
class Whitening:
    """``n`` distinct vectors with these sums, their leading axes (as columns),
    eigenvalues and shares of the variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: list[float]
    explained: list[float]

    def applied(self, rows: DataFrame, carry: str | None) -> DataFrame:
        """``whitened`` (array) and ``deviation`` of each ``x``, beside the column ``carry``."""
        n, sums, axes, values = self.n, self.sums, self.axes, np.sqrt(self.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("x"))
                most = n * int(max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))) + max(map(abs, sums), default=0)
                small = len(sums) * most * most < 1 << 62
                off = n * x - np.array(sums, np.int64) if small else n * x.astype(object) - np.array(sums, object)
                squares = [int(v) for v in (off * off).sum(axis=1)]
                # Quotients of whole numbers, rounded once.
                centred = (off / n).astype(np.float64)
                white = centred @ axes / values
                out = [pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()), pa.array(white.tolist(), pa.list_(pa.float64()))]
                names = ["deviation", "whitened"]
                if carry:
                    out, names = [batch.column(carry), *out], [carry, *names]
                yield pa.record_batch(out, names=names)

        kind = f"{carry} {rows.schema[carry].dataType.simpleString()}, " if carry else ""
        return rows.select(*([carry] if carry else []), "x").mapInArrow(run, f"{kind}deviation long, whitened array<double>")


def fit(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors ``x`` of whole numbers; None without any."""
    n = vectors.count()
    if n == 0:
        return None
    first = _added(vectors, None)
    width = len(first)
    sums = [first[-1, j] for j in range(width)]
    # Centred on the whole number nearest the mean before multiplying; what is
    # left of the mean, at most a half, is taken out exactly.
    centre = [(2 * s + n) // (2 * n) for s in sums]
    added = _added(vectors, centre)
    rest = [added.get((-1, j), 0) for j in range(width)]
    cov = np.array([[(n * added[i, j] - rest[i] * rest[j]) / (n * n) for j in range(width)] for i in range(width)])
    cov = cov.reshape(width, width)
    found = leading(cov, k) if width else []
    axes = np.array([v for _, v in found]).reshape(len(found), width).T
    values = [e for e, _ in found]
    return Whitening(n, sums, axes, values, [e / float(np.trace(cov)) for e in values])


def whitened(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per row of ``embeddings`` (``vec_id``, ``embedding``) and
    component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``.

    A row whose vector is null or holds a null or a number that is not finite
    is left out.  Vectors count as whole 256ths, rounded down (beyond the range of a long, its
    end); a shorter vector as if zeros followed.  The fit is over each distinct
    vector once, so copies weigh nothing, yet each row that repeats a vector or
    an id, and each row without an id, is returned.  A component whose
    eigenvalue is zero to double precision cannot be whitened and is left out,
    so fewer than ``k`` may come, and none from a single distinct vector or an
    empty table.  ``deviation`` is null where a long cannot hold it.
    """
    rows = embeddings.filter(finite(F.col("embedding"))).select("vec_id", whole(F.col("embedding")).alias("x"))
    rows = filled(rows)
    distinct = stored(rows.select("x").distinct(), "fit")
    model = fit(distinct, k)
    if model is None or not model.values:
        model = model or Whitening(0, [], np.zeros((0, 0)), [], [])
        return rows.limit(0).select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"),
            F.lit(0).cast("bigint").alias("deviation"), F.lit(0.0).alias("whitened"),
            F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"),
        )
    own = model.applied(distinct, None)
    size = range(len(model.values))
    pairs = [(i, j) for i in size for j in size if i <= j]
    moments = own.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(moments, pairs, strict=True))
    explained = F.array(*[F.lit(e) for e in model.explained])
    out = model.applied(rows, "vec_id").select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
