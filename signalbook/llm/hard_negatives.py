"""Hard negatives of anchors, by the threshold algorithm over sorted lists.

Candidates are held in blocks.  A block has one list per dimension, sorted by
that component.  An anchor reads all lists from the end that its sign makes
the better one, a little deeper each time; every row it meets first is scored
by its whole vector.  No row that it has not met can score more than the sum,
over dimensions, of the anchor's component times the last one read, and an
anchor stops once that sum is strictly below the k-th score of each of its
windows, or below the window itself.

Anchors and candidates meet in cells, a bounded number of anchors with a share
of the candidates that streams by, so no task holds a table.  The work grows
with anchors times candidates as far as the lists do not end it earlier.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbook.llm.store import stored

#: Components are taken as whole multiples of one ``SCALE``-th.
SCALE = 256
#: Candidates whose sorted lists a task holds at a time.
BLOCK = 8_192
#: Candidates and anchors of a cell, about.
PART = 131_072
ANCHORS = 2_048
_LONG = (-(1 << 63), (1 << 63) - 1)


def whole(vector: Column) -> Column:
    """``floor(256 c)`` of each component ``c``, as a long; beyond the range of
    a long, its end."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(F.lit(float(SCALE)) * c))


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    number = vector.cast("array<double>")
    return F.coalesce(
        F.forall(number, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False)
    )


def filled(rows: DataFrame) -> DataFrame:
    """``x`` of all rows with zeros up to the greatest length."""
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x"))))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def exact(x: np.ndarray, y: np.ndarray) -> type:
    """A kind of number in which products of rows of ``x`` and ``y`` are exact."""
    most = max(1, x.shape[1]) * int(max(abs(int(v)) for m in (x, y) for v in (m.min(initial=0), m.max(initial=0)))) ** 2
    return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object


class Lists:
    """A block of candidates and its list per dimension."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, kind: type) -> None:
        self.x, self.ids, self.labels = x.astype(kind), ids, labels
        self.order = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.order, axis=0).astype(kind)

    def search(self, anchor: np.ndarray, fits: np.ndarray, windows: list[Best]) -> int:
        """Offers to ``windows`` all rows among those that fit which they can
        need; returns how many rows were scored."""
        n = len(self.ids)
        used = np.flatnonzero(anchor != 0)
        used = used if len(used) else np.arange(1)
        up, down = used[anchor[used] >= 0], used[anchor[used] < 0]
        met, scored = np.zeros(n, bool), 0
        depth, deeper = 0, min(16, n)
        while depth < n:
            rows = np.concatenate([self.order[n - deeper : n - depth, up].ravel(), self.order[depth:deeper, down].ravel()])
            new = np.zeros(n, bool)
            new[rows] = True
            rows = np.flatnonzero(new & ~met)
            met |= new
            scored += len(rows)
            rows = rows[fits[rows]]
            if len(rows):
                scores = self.x[rows] @ anchor
                for window in windows:
                    window.offer(scores, self.ids[rows], rows, self)
            depth, deeper = deeper, min(n, 2 * deeper)
            best = self.values[n - depth, up] @ anchor[up] + self.values[depth - 1, down] @ anchor[down]
            if all(window.closed(best) for window in windows):
                break
        return scored


class Best:
    """The first ``k`` rows with a score from ``low`` to ``high``: higher scores
    first, ties by smaller id."""

    def __init__(self, k: int, low: int | None, high: int | None, anchor: np.ndarray) -> None:
        self.k, self.low, self.high, self.anchor = k, low, high, anchor
        self.rows: list[tuple[int, int, bool]] = []  # minus score, id, whether the vector is the anchor's

    def offer(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, block: Lists) -> None:
        ok = np.ones(len(scores), bool)
        if self.low is not None:
            ok &= scores >= self.low
        if self.high is not None:
            ok &= scores <= self.high
        if len(self.rows) == self.k:
            ok &= scores >= -self.rows[-1][0]
        at = np.flatnonzero(ok)
        if len(at) > 4 * self.k and scores.dtype != object:
            kth = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= kth]
        if len(at):
            more = [(-int(scores[i]), int(ids[i]), bool((block.x[rows[i]] == self.anchor).all())) for i in at.tolist()]
            self.rows = sorted(self.rows + more)[: self.k]

    def closed(self, best) -> bool:
        """Whether no row that scores at most ``best`` can come in any more."""
        if self.low is not None and best < self.low:
            return True
        return len(self.rows) == self.k and best < -self.rows[-1][0]


_CELL = ["a", "p", "kind", "id", "label", "x", "bounds"]
FOUND = "g long, bound long, id long, score long, own boolean"


def _cells(k: int, same: bool, low: int | None, high: int | None, of: int, block_rows: int):
    """A ``mapInArrow`` function over rows sorted by cell, anchors first: of
    every anchor and bound the best ``k`` rows of the cell."""

    def windows_of(bounds: list[int], anchor: np.ndarray) -> list[tuple[int, Best]]:
        if low is None:
            return [(0, Best(k, None, None, anchor))]
        # In whole numbers of any size; where low is above high, nothing fits.
        spans = [(b, -(-low * b // of), high * b // of) for b in bounds]
        return [(b, Best(k, lo, hi, anchor)) for b, lo, hi in spans if lo <= hi]

    def results(anchors) -> pa.RecordBatch:
        cut = lambda score: min(max(score, _LONG[0]), _LONG[1])
        rows = [(g, b, r[1], cut(-r[0]), r[2]) for g, _, _, own in anchors for b, w in own for r in w.rows]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.bool_()]
        return pa.record_batch(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["g", "bound", "id", "score", "own"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors, waiting, n_waiting = None, [], [], 0

        def compare() -> None:
            nonlocal waiting, n_waiting
            if waiting and anchors:
                x, ids, labels = (np.concatenate(c) for c in zip(*waiting, strict=True))
                asked = np.stack([a for _, _, a, _ in anchors])
                kind = exact(x, asked)
                block = Lists(x, ids, labels, kind)
                for _, label, anchor, own in anchors:
                    if own:
                        block.search(anchor.astype(kind), (labels == label) == same, [w for _, w in own])
            waiting, n_waiting = [], 0

        for batch in batches:
            a, p, kind = (batch.column(c).to_numpy() for c in ("a", "p", "kind"))
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            x = matrix(batch.column("x"))
            bounds = batch.column("bounds").to_pylist()
            cuts = np.flatnonzero((np.diff(a) != 0) | (np.diff(p) != 0) | (np.diff(kind) != 0)) + 1
            for begin, end in zip(np.r_[0, cuts], np.r_[cuts, len(a)], strict=True):
                if begin == end:
                    continue
                if cell != (a[begin], p[begin]):
                    compare()
                    if anchors:
                        yield results(anchors)
                    cell, anchors = (a[begin], p[begin]), []
                if kind[begin] == 0:
                    for i in range(begin, end):
                        anchors.append((int(ids[i]), labels[i], x[i], windows_of(bounds[i] or [], x[i])))
                    continue
                for at in range(begin, end, block_rows):
                    stop = min(end, at + block_rows)
                    waiting.append((x[at:stop], ids[at:stop], labels[at:stop]))
                    n_waiting += stop - at
                    if n_waiting >= block_rows:
                        compare()
        compare()
        if anchors:
            yield results(anchors)

    return run


def searched(
    candidates: DataFrame, asked: DataFrame, k: int, same: bool, span: tuple[int, int, int] | None, block: int = BLOCK
) -> DataFrame:
    """``g``, ``bound``, ``id``, ``score``, ``own``, ``rank``: for each row of
    ``asked`` (``g``, ``label``, ``x``, ``bounds``) and each of its bounds the
    first ``k`` candidates of the same label, or of others, that score from
    ``span[0]`` to ``span[1]`` ``span[2]``-ths of the bound; without a span, of all."""
    n, m = candidates.count(), asked.count()
    slots = candidates.sparkSession.sparkContext.defaultParallelism
    rows_of_cells = max(1, math.ceil(m / ANCHORS))
    parts = max(1, math.ceil(n / PART), min(math.ceil(n / block), math.ceil(slots / rows_of_cells)))
    number = lambda key, count: F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    lines = asked.select(
        number(["g"], rows_of_cells).alias("a"), every(parts).alias("p"), F.lit(0).alias("kind"),
        F.col("g").alias("id"), "label", "x", "bounds",
    )
    columns = candidates.select(
        every(rows_of_cells).alias("a"), number(["vec_id", "label"], parts).alias("p"), F.lit(1).alias("kind"),
        F.col("vec_id").alias("id"), "label", "x", F.lit(None).cast("array<bigint>").alias("bounds"),
    )
    both = lines.unionAll(columns).repartition(rows_of_cells * parts, "a", "p").sortWithinPartitions("a", "p", "kind")
    low, high, of = span or (None, None, 1)
    found = both.mapInArrow(_cells(k, same, low, high, of, block), FOUND)
    first = Window.partitionBy("g", "bound").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    span: tuple[int, int, int] = (30, 90, 100),
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score`` for the rows of ``embeddings``
    (``vec_id``, ``label``, ``embedding``) for which ``is_anchor`` holds.

    A row takes part if its id and label are not null and its vector has only
    finite numbers.  Its vector counts as whole numbers (:func:`whole`); a
    shorter one as if zeros followed.  Scores are exact inner products, cut to
    the range of a long only when they are returned.  The positives of an
    anchor are the first other rows of its label; the negatives of a positive
    the first rows of other labels whose score lies from ``span[0]`` to
    ``span[1]`` ``span[2]``-ths of the positive's, both included: none where
    that is below zero.  Higher scores come first, ties by smaller id.

    Fully equal rows count once; rows that repeat an id with another vector or
    label are rows of their own.  Of the rows that share label and vector only
    the smallest ids are searched, which are all that a list can show, and
    equal anchors search once; so a vector that many rows repeat costs like one.
    An empty table, or one without anchors, gives an empty one.
    """
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding")))
    anchor = F.coalesce(is_anchor, F.lit(False))
    rows = rows.select("vec_id", F.col("label").cast("bigint").alias("label"), whole(F.col("embedding")).alias("x"), anchor.alias("anchor"))
    rows = stored(filled(rows).distinct(), "rows")
    alike = Window.partitionBy("label", "x").orderBy("vec_id")
    kept = rows.withColumn("at", F.row_number().over(alike)).filter(F.col("at") <= max(positives + 1, negatives))
    candidates = kept.select("vec_id", "label", "x")
    anchors = rows.filter("anchor").select("vec_id", "label", "x")
    asked = stored(anchors.select("label", "x").distinct().withColumn("g", F.monotonically_increasing_id()), "asked")
    none = F.lit(None).cast("array<bigint>").alias("bounds")
    near = searched(candidates, asked.select("g", "label", "x", none), positives + 1, True, None, block)
    near = near.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score", "own"))).alias("near"))
    of_anchor = anchors.join(asked, ["label", "x"]).select(F.col("vec_id").alias("anchor_id"), "g").join(near, "g")
    others = F.filter("near", lambda r: ~(r.own & (r.id == F.col("anchor_id"))))
    pairs = of_anchor.select("anchor_id", "g", F.explode(F.slice(others, 1, positives)).alias("r"))
    pairs = stored(pairs.select("anchor_id", "g", F.col("r.id").alias("positive_id"), F.col("r.score").alias("bound")), "positives")
    bounds = pairs.groupBy("g").agg(F.collect_set("bound").alias("bounds"))
    hard = searched(candidates, asked.join(bounds, "g").select("g", "label", "x", "bounds"), negatives, False, span, block)
    return pairs.join(hard.select("g", "bound", "rank", "id", "score"), ["g", "bound"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        F.col("bound").alias("positive_score"), F.col("score").alias("negative_score"),
    )
