"""The best partners of every row by inner product, complete and with ties by id.

Rows that ask and rows that are offered meet in cells, a bounded number of
askers with a share of the offered rows that streams by in falling order of
length.  A product is at most the product of the lengths, so an asker is done
with a cell once that bound is below its last score; where lengths differ, as
those of the factors of popular and of rare songs do, most of a cell is never
multiplied.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Executors get these functions by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a cell that ask, and that are offered; offered rows that are multiplied at a time.
ASKING = 4_096
OFFERED = 131_072
BLOCK = 2_048
#: Pairs that are held before they are cut back to the best.
HELD = 1_000_000


class Best:
    """The ``k`` best points of each query among those added: by exact score,
    ties by smaller id.  Scores come in as products of matrices, right but for
    rounding; whatever is within ``slack`` of a cut is summed in the order of
    the components before it is made.  A point may be added more than once; it
    is known by its number."""

    def __init__(
        self, k: int, queries: np.ndarray, points: np.ndarray, numbers: np.ndarray, ids: np.ndarray, slack: float
    ) -> None:
        self.k, self.queries, self.points, self.slack = k, queries, points, slack
        self.numbers, self.ids = numbers, ids
        self.least = np.full(len(queries), -np.inf)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, rows: np.ndarray, first: int, scores: np.ndarray) -> None:
        """Scores of the queries ``rows`` with the points from ``first`` on."""
        near, point = np.nonzero(scores >= (self.least[rows] - self.slack)[:, None])
        self.parts.append((rows[near], point + first, scores[near, point]))
        self.n += len(near)
        if self.n > HELD:
            self.cut()

    def _exact(self, q: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = np.empty(len(q))
        for at in range(0, len(q), 1 << 16):
            some = slice(at, at + (1 << 16))
            out[some] = np.cumsum(self.queries[q[some]] * self.points[v[some]], axis=1)[:, -1]
        return out

    @staticmethod
    def _places(q: np.ndarray) -> np.ndarray:
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        return np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, points and scores of the best so far, in order."""
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        q, v, score = (np.concatenate(c) for c in zip(*self.parts, strict=True)) if self.parts else none
        order = np.lexsort((self.numbers[v], q))
        q, v, score = q[order], v[order], score[order]
        number = self.numbers[v]
        new = np.r_[True, (q[1:] != q[:-1]) | (number[1:] != number[:-1])][: len(q)]
        q, v, score = q[new], v[new], score[new]
        order = np.lexsort((-score, q))
        q, v, score = q[order], v[order], score[order]
        kth = np.full(len(self.queries), -np.inf)
        last = self._places(q) == self.k - 1
        kth[q[last]] = score[last]
        near = score >= kth[q] - self.slack
        q, v = q[near], v[near]
        score = self._exact(q, v)
        order = np.lexsort((self.numbers[v], self.ids[v], -score, q))
        q, v, score = q[order], v[order], score[order]
        top = self._places(q) < self.k
        q, v, score = q[top], v[top], score[top]
        last = self._places(q) == self.k - 1
        self.least[q[last]] = score[last]
        self.parts, self.n = [(q, v, score)], 0
        return q, v, score


def rounding(width: int, longest: float, other: float) -> float:
    """How far products of vectors of these lengths may be off, summed in any order."""
    return 4 * (width + 1) * float(np.finfo(float).eps) * longest * other


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def _cells(k: int, block: int):
    """A ``mapInArrow`` function over rows sorted by cell, askers first, then
    offered rows by falling length."""

    def results(askers: np.ndarray, held: list) -> pa.RecordBatch:
        rows = [np.concatenate(c) for c in zip(*held, strict=True)] if held else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.record_batch(
            [pa.array(askers[rows[0].astype(np.int64)]), pa.array(rows[1].astype(np.int64)), pa.array(rows[2])],
            names=["asking", "offered", "score"],
        )

    def compare(queries: np.ndarray, kept: list, ids: np.ndarray, points: np.ndarray) -> list:
        """``kept`` with the best of one more block of points."""
        lengths = np.linalg.norm(queries, axis=1)
        longest = float(np.linalg.norm(points, axis=1).max())
        slack = rounding(points.shape[1], float(lengths.max(initial=0.0)), longest)
        best = Best(k, queries, points, ids, ids, slack)
        if kept:
            best.least[:] = kept[1]
        # Ties with the last score still count, as their ids may be smaller.
        open_ = np.flatnonzero(lengths * longest + slack >= best.least)
        if not len(open_):
            return kept
        for at in range(0, len(open_), 1_024):
            some = open_[at : at + 1_024]
            best.add(some, 0, queries[some] @ points.T)
        q, v, score = best.cut()
        found = (q, ids[v], score)
        if kept:
            found = tuple(np.concatenate(c) for c in zip(kept[0], found, strict=True))
            order = np.lexsort((found[1], -found[2], found[0]))
            found = tuple(c[order] for c in found)
            top = Best._places(found[0]) < k
            found = tuple(c[top] for c in found)
        least = np.full(len(queries), -np.inf)
        last = Best._places(found[0]) == k - 1
        least[found[0][last]] = found[2][last]
        return [found, least]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, askers, waiting, kept = None, [], [], []

        def flush() -> None:
            nonlocal waiting, kept
            if waiting and askers:
                ids, points = (np.concatenate(c) for c in zip(*waiting, strict=True))
                kept = compare(np.concatenate([x for _, x in askers]), kept, ids, points)
            waiting = []

        def ended() -> pa.RecordBatch:
            return results(np.concatenate([i for i, _ in askers]), kept[:1])

        for batch in batches:
            a, p, kind, ids = (batch.column(c).to_numpy() for c in ("a", "p", "kind", "id"))
            x = _matrix(batch.column("x"))
            cuts = np.flatnonzero((np.diff(a) != 0) | (np.diff(p) != 0) | (np.diff(kind) != 0)) + 1
            for begin, end in zip(np.r_[0, cuts], np.r_[cuts, len(a)], strict=True):
                if begin == end:
                    continue
                if cell != (a[begin], p[begin]):
                    flush()
                    if askers:
                        yield ended()
                    cell, askers, kept = (a[begin], p[begin]), [], []
                if kind[begin] == 0:
                    askers.append((ids[begin:end], x[begin:end]))
                    continue
                for at in range(begin, end, block):
                    stop = min(end, at + block)
                    waiting.append((ids[at:stop], x[at:stop]))
                    if sum(len(i) for i, _ in waiting) >= block:
                        flush()
        flush()
        if askers:
            yield ended()

    return run


def top_products(asking: DataFrame, offered: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """``asking``, ``offered``, ``rank``, ``score``: for each row of ``asking``
    (``id``, a long, and ``features``, numbers) the ``n`` rows of ``offered`` with
    the largest inner product; equal scores by smaller id, all of them looked at.

    Scores are doubles, summed in the order of the components.  Rows without
    an id or with a null or a number that is not finite take no part; ids are
    unique on either side; a shorter vector counts as if zeros followed.
    """

    def usable(df: DataFrame) -> DataFrame:
        x = F.col("features").cast("array<double>")
        finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        return df.select(F.col("id").cast("bigint").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))

    asking, offered = usable(asking), usable(offered)
    m, wide = asking.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    count, width = offered.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    width = max(wide or 0, width or 0)
    slots = asking.sparkSession.sparkContext.defaultParallelism
    rows = max(1, math.ceil(m / ASKING))
    parts = max(1, math.ceil(count / OFFERED), min(math.ceil(count / block), math.ceil(slots / rows)))
    number = lambda k: F.pmod(F.xxhash64("id"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    filled = F.concat("x", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("x"))).alias("x")
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c)).alias("length")
    lines = asking.select(number(rows).alias("a"), every(parts).alias("p"), F.lit(0).alias("kind"), "id", filled, length)
    columns = offered.select(every(rows).alias("a"), number(parts).alias("p"), F.lit(1).alias("kind"), "id", filled, length)
    both = lines.unionAll(columns).repartition(rows * parts, "a", "p")
    both = both.sortWithinPartitions("a", "p", "kind", F.desc("length"))
    found = both.mapInArrow(_cells(n, block), "asking long, offered long, score double")
    order = Window.partitionBy("asking").orderBy(F.desc("score"), "offered")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select("asking", "offered", "rank", "score")
