"""Nearest neighbours by inner product from a forest of random-projection trees.

Trees split a bounded sample at the median of a projection on the difference
of two of its vectors; every vector is then sent down every tree.  A query
goes down all trees through one priority queue, the most promising branch of
any tree first, until the leaves it reached hold enough vectors; these are
ranked exactly.  Vectors are lifted by one dimension to equal length, where
the largest inner product is the smallest angle.

How many vectors are enough is measured: some queries are answered exactly,
and the budget is what their neighbours took to come up in the queue.  Where
the data has clusters that is a small number; where it has none, as with
random vectors in many dimensions, it is a share of all.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalbook.llm.store import stored
from signalbook.operators.top_products import Best, rounding

TREES = 10
#: Vectors in a leaf, as far as the sample is fine enough for it.
LEAF = 32
#: Vectors of the sample that the trees are fitted on.
SAMPLE = 30_000
#: Bytes that the planes of the forest may take; leaves get larger beyond that.
PLANES = 64 << 20
#: Queries that are answered exactly to set the budget, and the part of their
#: neighbours that the budget must reach.
TRIALS = 100
TARGET = 0.94
#: Vectors in the leaves that a query visits, at least.
SEARCHED = 2_000
#: Bytes of the vectors that one task compares, and queries it compares them with.
PER_TASK = 64 << 20
QUERIES = 65_536
#: Parts of the index, at least.
PARTS = 24


@dataclass
class Tree:
    """Inner nodes 0, 1, ... with a plane each; children below 0 are leaves -1 - i."""

    planes: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    n_leaves: int


def grown(sample: np.ndarray, leaf: float, seed: int) -> Tree:
    """A tree whose leaves hold at most ``leaf`` vectors of the sample, but for
    those that no projection separates."""
    rng = np.random.default_rng(seed)
    planes, cuts, children, n_leaves = [], [], [], 0
    todo = [(np.arange(len(sample)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        for _ in range(3 if len(rows) > max(1.0, leaf) else 0):
            a, b = sample[rng.choice(rows, 2, replace=False)]
            plane = a - b
            norm = np.linalg.norm(plane)
            if norm == 0:
                continue
            along = sample[rows] @ (plane / norm).astype(np.float32)
            cut = float(np.median(along))
            right = along > cut
            if right.any():
                split = plane / norm, cut, right
                break
        if split is None:
            own = -1 - n_leaves
            n_leaves += 1
        else:
            own = len(planes)
            planes.append(split[0].astype(np.float32))
            cuts.append(split[1])
            children.append([0, 0])
            todo += [(rows[split[2]], own, 1), (rows[~split[2]], own, 0)]
        if parent >= 0:
            children[parent][side] = own
    dim = sample.shape[1]
    return Tree(np.array(planes, np.float32).reshape(-1, dim), np.array(cuts), np.array(children, int).reshape(-1, 2), n_leaves)


def leaves(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """The leaf of each vector."""
    out = np.zeros(len(vectors), dtype=np.int64)
    todo = [(0 if len(tree.planes) else -1, np.arange(len(vectors)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if node < 0:
            out[rows] = -1 - node
            continue
        right = vectors[rows] @ tree.planes[node] > tree.cuts[node]
        todo += [(tree.children[node, 1], rows[right]), (tree.children[node, 0], rows[~right])]
    return out


def visited(forest: list[Tree], sizes: list[np.ndarray], query: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(tree, leaf, size) in the order of the shared queue.  A branch is as
    promising as the sum of the squares of the margins that were passed over on
    its way is small.  Margins are taken only along the way."""
    queue = [(0.0, t, 0 if len(tree.planes) else -1) for t, tree in enumerate(forest)]
    while queue:
        passed, t, node = heapq.heappop(queue)
        tree = forest[t]
        while node >= 0:
            margin = float(tree.planes[node] @ query) - tree.cuts[node]
            low, high = tree.children[node]
            near, far = (high, low) if margin > 0 else (low, high)
            heapq.heappush(queue, (passed + margin * margin, t, int(far)))
            node = int(near)
        leaf = -1 - node
        if sizes[t][leaf]:
            yield t, leaf, int(sizes[t][leaf])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, longest * longest - (vectors * vectors).sum(axis=1)))
    return np.hstack([vectors, rest[:, None]])


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``vector`` (doubles) of the rows that take part: no null, no
    zero vector, no component that is null or not finite."""
    return embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).filter(
        "vec_id is not null and size(vector) > 0 and exists(vector, x -> x <> 0)"
        " and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )


def nearest(embeddings: DataFrame, is_query: Column, k: int = 20, searched: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found
    per query: rows of ``embeddings`` (``vec_id``, ``embedding``) for which the
    condition ``is_query`` holds.

    A query is no neighbour of its own id, and is compared with vectors of its
    own length only.  Higher scores come first, ties by smaller ``vec_id``, however many
    share a score.  Equal vectors are indexed once, by
    their ``k + 1`` smallest ids, which are all that a list of ``k`` can show;
    so a vector that many rows repeat weighs like one.  Repeated ids with the
    same vector count once.  An empty table, or one without queries, gives an
    empty one.  ``searched`` sets the budget by hand; with fewer vectors than
    that, all are found.
    """
    rows = usable(embeddings).distinct()
    lengths = [r[0] for r in rows.select(F.size("vector").alias("n")).distinct().orderBy("n").collect()]
    found = [_nearest(rows.filter(F.size("vector") == n), is_query, k, searched) for n in lengths]
    if not found:
        return rows.limit(0).select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def fitted(vectors: DataFrame, n: int, longest: float) -> list[Tree]:
    """The forest of a table of vectors, from a sample of them."""
    draw = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = vectors.filter(draw * n < SAMPLE).select("vector").toArrow().column("vector").combine_chunks()
    lifted = _lifted(_matrix(sample), longest) if len(sample) else np.zeros((0, 1))
    if not len(sample):
        width = len(vectors.first().vector) + 1
        return [Tree(np.zeros((0, width), np.float32), np.zeros(0), np.zeros((0, 2), int), 1)]
    lifted = lifted[np.lexsort(lifted.T)]
    nodes = max(1, PLANES // (4 * TREES * lifted.shape[1]))
    leaf = max(LEAF * len(lifted) / n, 2 * len(lifted) / nodes)  # halving may end at half a leaf
    return [grown(lifted, leaf, seed) for seed in range(TREES)]


def trials(asked: DataFrame, vectors: DataFrame, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Some queries, and the ``k`` nearest vectors of each but its own, from all vectors."""
    some = asked.orderBy(F.xxhash64("vector"), "v").limit(TRIALS).toArrow()
    queries = _matrix(some.column("vector").combine_chunks())
    own = some.column("v").to_numpy()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = queries @ _matrix(batch.column("vector")).T
            scores[own[:, None] == batch.column("v").to_numpy()[None, :]] = -np.inf
            top = min(k, batch.num_rows)
            at = np.argpartition(-scores, top - 1, axis=1)[:, :top]
            trial = np.repeat(np.arange(len(queries)), top)
            yield pa.record_batch(
                [pa.array(trial), pa.array(np.take_along_axis(scores, at, axis=1).ravel()), batch.column("vector").take(pa.array(at.ravel()))],
                names=["trial", "score", "vector"],
            )

    near = vectors.select("v", "vector").mapInArrow(best, "trial long, score double, vector array<double>")
    first = Window.partitionBy("trial").orderBy(F.desc("score"))
    near = near.filter("score > double('-infinity')").withColumn("at", F.row_number().over(first))
    found = near.filter(F.col("at") <= k).select("trial", "vector").toArrow()
    trial, nearest_ = found.column("trial").to_numpy(), _matrix(found.column("vector").combine_chunks())
    return queries, [nearest_[trial == i] for i in range(len(queries))]


def budget(
    forest: list[Tree], sizes: list[np.ndarray], queries: np.ndarray, neighbours: list[np.ndarray], longest: float
) -> int:
    """Vectors in the leaves that a query must visit to find :data:`TARGET` of
    its neighbours, as these queries do."""
    taken: list[int] = []
    for query, near in zip(np.hstack([queries, np.zeros((len(queries), 1))]), neighbours, strict=True):
        lifted = _lifted(near.reshape(-1, len(query) - 1), longest)
        at = np.stack([leaves(tree, lifted) for tree in forest])
        missing = np.ones(len(near), bool)
        held = 0
        for t, leaf, size in visited(forest, sizes, query):
            if not missing.any():
                break
            held += size
            hit = missing & (at[t] == leaf)
            taken += [held] * int(hit.sum())
            missing &= ~hit
    return int(np.quantile(taken, TARGET, method="higher")) if taken else 0


def _nearest(rows: DataFrame, is_query: Column, k: int, searched: int | None) -> DataFrame:
    """:func:`nearest` among distinct (``vec_id``, ``vector``) of one length."""
    same = Window.partitionBy("vector").orderBy("vec_id")
    first = rows.withColumn("at", F.row_number().over(same)).filter(F.col("at") <= k + 1)
    vectors = first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    vectors = stored(vectors.withColumn("v", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    n, longest, width = vectors.agg(F.count(F.lit(1)), F.sqrt(F.max(square)), F.max(F.size("vector"))).first()
    queries = rows.filter(is_query).join(vectors.select("vector", "v"), "vector").select("vec_id", "v")
    queries = stored(queries, "queries")
    asked = queries.select("v").distinct().join(vectors.select("v", "vector"), "v")
    n_asked = asked.count()
    if n_asked == 0:
        return queries.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        ).limit(0)
    forest = fitted(vectors, n, longest)
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(forest)
    # The index and the queries meet part by part; both may be cut further.
    parts = max(PARTS, math.ceil(n * len(forest) * width * 8 / PER_TASK))
    blocks = math.ceil(n_asked / QUERIES)
    slack = rounding(width, longest, longest)

    def code(t, leaf):
        return leaf * len(forest) + t

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lifted = _lifted(_matrix(batch.column("vector")), longest)
            for t, tree in enumerate(shared.value):
                at = code(t, leaves(tree, lifted))
                yield pa.record_batch(
                    [pa.array((at % parts).astype(np.int32)), pa.array(at), batch.column("v"), batch.column("first"), batch.column("vector")],
                    names=["part", "leaf", "v", "first", "vector"],
                )

    index = vectors.select("v", F.col("ids")[0].alias("first"), "vector").mapInArrow(
        placed, "part int, leaf long, v long, first long, vector array<double>"
    )
    index = stored(index, "index")
    counted = index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).toPandas()
    sizes = [np.zeros(t.n_leaves, np.int64) for t in forest]
    for at, size in counted.itertuples(index=False):
        sizes[at % len(forest)][at // len(forest)] = size
    if searched is None:
        searched = max(SEARCHED, budget(forest, sizes, *trials(asked, vectors, k), longest))
    shared_sizes = spark.sparkContext.broadcast(sizes)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per query and part with the leaves that it visits there."""
        for batch in batches:
            matrix = _matrix(batch.column("vector"))
            rows, into, lists = [], [], []
            for i, query in enumerate(np.hstack([matrix, np.zeros((len(matrix), 1))])):
                ways, held = [], 0
                for t, leaf, size in visited(shared.value, shared_sizes.value, query):
                    ways.append(code(t, leaf))
                    held += size
                    if held >= searched:
                        break
                ways = np.array(ways, np.int64)
                ways = ways[np.argsort(ways % parts, kind="stable")]
                own, starts = np.unique(ways % parts, return_index=True)
                rows += [i] * len(own)
                into += own.tolist()
                lists += np.split(ways, starts[1:])
            yield pa.record_batch(
                [pa.array(into, pa.int32()), batch.column("v").take(pa.array(rows, pa.int64())), pa.array(lists, pa.list_(pa.int64())), batch.column("vector").take(pa.array(rows, pa.int64()))],
                names=["part", "q", "leaves", "query"],
            )

    kinds = pa.schema([("q", pa.int64()), ("v", pa.int64()), ("first", pa.int64()), ("score", pa.float64())])

    def compared(asks: pa.Table, own: pa.Table) -> pa.Table:
        """The best ``k + 1`` of each query over all leaves of one part."""
        if not len(asks) or not len(own):
            return kinds.empty_table()
        own = own.sort_by("leaf")
        ids, numbers = own.column("first").to_numpy(), own.column("v").to_numpy()
        points, queries_ = (_matrix(t.column(c).combine_chunks()) for t, c in ((own, "vector"), (asks, "query")))
        lists = asks.column("leaves").combine_chunks()
        wanted = lists.flatten().to_numpy()
        row = np.repeat(np.arange(len(asks)), np.diff(lists.offsets.to_numpy()))
        order = np.argsort(wanted, kind="stable")
        wanted, row = wanted[order], row[order]
        best = Best(k + 1, queries_, points, numbers, ids, slack)
        held, starts = np.unique(own.column("leaf").to_numpy(), return_index=True)
        ends = np.r_[starts[1:], len(points)]
        low, high = np.searchsorted(wanted, held), np.searchsorted(wanted, held, side="right")
        for a, b, begin, end in zip(starts, ends, low, high, strict=True):
            for at in range(begin, end, 1024):
                some = row[at : min(end, at + 1024)]
                best.add(some, a, queries_[some] @ points[a:b].T)
        q, v, score = best.cut()
        asked_ = asks.column("q").to_numpy()
        return pa.table([pa.array(asked_[q]), pa.array(numbers[v]), pa.array(ids[v]), pa.array(score)], schema=kinds)

    block = F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block")
    routes = asked.mapInArrow(routed, "part int, q long, leaves array<long>, query array<double>").select("*", block)
    held = index if blocks == 1 else index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    held = held.withColumn("block", F.lit(0)) if blocks == 1 else held
    near = (
        routes.groupBy("part", "block")
        .cogroup(held.groupBy("part", "block"))
        .applyInArrow(compared, "q long, v long, first long, score double")
        .groupBy("q", "v")
        .agg(F.max("score").alias("score"), F.min("first").alias("first"))
    )
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "first", "v")
    near = near.withColumn("at", F.row_number().over(by_score)).filter(F.col("at") <= k + 1).select("q", "v", "score")
    exact = near.join(vectors.select("v", "ids"), "v").select("q", F.explode("ids").alias("vec_id"), "score")
    found = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).join(exact, "q")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.filter("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
