"""Near duplicates by an inverted join on MinHash coordinates.

Every distinct set of shingles gets a signature of ``COORDINATES`` minima and
is posted under each (coordinate, value) pair.  Two sets with a similarity of
0.75 share three quarters of the coordinates on average; fewer than
``MATCHES`` of 64 happens once in millions of such pairs.  So only pairs with
at least ``MATCHES`` equal coordinates are looked at, and each of them is
confirmed or refused on the full sets.

The lists are merged with two savings.  *Prefix*: of two sets with ``MATCHES``
common pairs, one is among all but the ``MATCHES - 1`` most frequent pairs of
each; the frequent pairs, under which a common passage gathers its documents,
are not merged at all.  *Skip*: once all the documents of a list are known to
be connected, the list has nothing to add and is skipped.  To get there, each
list is first merged against two of its members only, which connects a large
group of copies with as many comparisons as it has members; what remains are
lists with several components, and there every pair across components counts
whose sets have enough shingles that occur in more than one component, and
whose parity maps leave room for the overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalbook.llm.components import components
from signalbook.llm.shingles import mixed, shingle_sets
from signalbook.llm.store import slices, stored

COORDINATES = 64
MATCHES = 30
#: Bits of a set's parity map: bit ``h`` is whether an odd number of its members
#: hash to ``h``.  Two sets differ in at least as many members as their maps in
#: bits, which bounds their overlap without the sets.
PARITY_BITS = 1024
#: Shingles per step of the signature; keeps a step's arrays in the cache.
_STEP = 1 << 16
_rng = np.random.default_rng(7)
_FACTORS = _rng.integers(0, 1 << 31, COORDINATES).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_MASKS = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32)


def signatures(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The minimum of each coordinate's hash over each set, one row per set;
    sets must not be empty."""
    short = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(offsets) - 1, COORDINATES), dtype=np.uint32)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _STEP, "right")) - 1)
        part, starts = short[offsets[at] : offsets[to]], offsets[at:to] - offsets[at]
        for k in range(COORDINATES):
            h = (part ^ _MASKS[k]) * _FACTORS[k]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            out[at:to, k] = np.minimum.reduceat(h, starts)
        at = to
    return out


def _set_keys(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set, whatever the order of its members."""
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(sets ^ np.uint64(s)), dtype=np.uint64))) for s in (11, 13)]
    return tuple((c[offsets[1:]] - c[offsets[:-1]]).view(np.int64) for c in sums)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets, offsets = shingle_sets(batch.column("text"))
        n = np.diff(offsets)
        high, low = _set_keys(sets, offsets)
        full = np.flatnonzero(n)
        found = np.zeros((len(n), COORDINATES), dtype=np.uint32)
        if len(full):
            found[full] = signatures(sets, np.concatenate((offsets[full], offsets[-1:])))
        width = COORDINATES * 4
        ends = np.arange(len(n) + 1, dtype=np.int32) * width
        sketch = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(found.tobytes())])
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(n), pa.array(high), pa.array(low), sketch],
            names=["doc_id", "text_hash", "n_shingles", "high", "low", "sketch"],
        )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets, offsets = shingle_sets(batch.column("text"))
        arrays = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(sets.view(np.int64)))
        bit = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) * PARITY_BITS + (
            (sets >> np.uint64(8)) % np.uint64(PARITY_BITS)
        ).astype(np.int64)
        odd = np.bincount(bit, minlength=(len(offsets) - 1) * PARITY_BITS).astype(np.uint8) & 1
        words = PARITY_BITS // 64
        maps = pa.array(np.packbits(odd).view(np.int64))
        parity = pa.ListArray.from_arrays(pa.array(np.arange(len(offsets), dtype=np.int32) * words), maps)
        yield pa.record_batch(
            [batch.column("node"), pa.array(np.diff(offsets)), arrays, parity], names=["node", "n", "shingles", "parity"]
        )


def _coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per set and coordinate: the coordinate's number above its value."""
    place = np.arange(COORDINATES, dtype=np.int64) << 32
    for batch in batches:
        for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
            values = np.frombuffer(b"".join(part.column("sketch").to_pylist()), dtype=np.uint32)
            posts = (values.reshape(-1, COORDINATES) + place).ravel()
            nodes = np.repeat(part.column("node").to_numpy(zero_copy_only=False), COORDINATES)
            yield pa.record_batch([pa.array(nodes), pa.array(posts)], names=["node", "post"])


def _equal_coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs with enough equal coordinates."""
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)
            for c in ("sketch_a", "sketch_b")
        )
        enough = pa.array((a == b).sum(axis=1) >= MATCHES)
        yield batch.select(["a", "b"]).filter(enough)


def postings(classes: DataFrame) -> DataFrame:
    """``node``, ``post`` of the pairs that can lead to a partner: of the pairs
    a set shares with others, all but its ``MATCHES - 1`` most frequent."""
    posts = classes.filter("n_shingles > 0").select("node", "sketch").mapInArrow(_coordinates, "node long, post long")
    shared = posts.groupBy("post").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = posts.join(shared, "post").groupBy("node").agg(F.collect_list(F.struct("n", "post")).alias("posts"))
    first = F.slice(F.array_sort("posts"), F.lit(1), F.size("posts") - (MATCHES - 1))
    return own.filter(F.size("posts") >= MATCHES).select("node", F.explode(first).alias("p")).select("node", "p.post")


def _classes(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """The sketch of every row, and per class (``high``, ``low``,
    ``n_shingles``) its standing document ``one`` and its ``component``."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sketches = stored(
        docs.mapInArrow(
            _sketched, "doc_id long, text_hash long, n_shingles long, high long, low long, sketch binary"
        ),
        "sketches",
    )
    # One document stands for a class: that with the smallest id, nulls last.
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one")
    classes = stored(
        sketches.filter("n_shingles > 0")
        .groupBy("high", "low", "n_shingles")
        .agg(one, F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    posts = stored(postings(classes), "postings")
    sets = _sets_of(docs, classes, posts)
    roots = components(_links(classes.select("node", "sketch"), posts, sets, round(100 * similarity)))
    named = classes.drop("sketch").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return sketches.drop("sketch"), named


def near_duplicates(docs: DataFrame, similarity: float = 0.75) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of
    ``docs`` (``doc_id`` long, ``text`` string; others ignored).

    Rows with the same set of shingles are one class; links join classes whose
    sets have ``intersection >= similarity * union``.  A document's component
    is the smallest ``doc_id`` its class reaches, and it is kept if that is its
    own.  A text that is null or has no words has no shingles, no links, and is
    its own component.  A null ``doc_id`` has a null component unless its class
    reaches an id, and is never kept.  Repeated rows stay, each with the same
    answer; an empty table gives an empty one.
    """
    sketches, classes = _classes(docs, similarity)
    least = classes.groupBy("root").agg(F.min("one.doc_id").alias("component_id"))
    named = classes.join(least, "root").select("high", "low", "n_shingles", "component_id")
    answers = sketches.join(named, ["high", "low", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return answers.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def deduplicated(docs: DataFrame, similarity: float = 0.75) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest
    ``doc_id`` (nulls last; among rows of one id, that with the smallest text
    hash).  Rows without words all stay, as nothing links them."""
    sketches, classes = _classes(docs, similarity)
    stays = classes.groupBy("root").agg(F.min("one").alias("one")).select(
        F.col("one.doc_id").alias("__dup_id"), F.col("one.text_hash").alias("__dup_hash")
    )
    wordless = sketches.filter("n_shingles = 0").select(
        F.col("doc_id").alias("__dup_id"), F.col("text_hash").alias("__dup_hash")
    )
    stays = stays.withColumn("__dup_one", F.lit(True)).unionAll(wordless.distinct().withColumn("__dup_one", F.lit(False)))
    rows = docs.withColumn("__dup_text", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__dup_id")) & (F.col("__dup_text") == F.col("__dup_hash"))
    rows = rows.join(stays, same)
    # Identical rows of a standing document: one of them.
    turn = Window.partitionBy("__dup_id", "__dup_hash").orderBy(F.lit(0))
    rows = rows.withColumn("__dup_turn", F.row_number().over(turn))
    return rows.filter((F.col("__dup_turn") == 1) | ~F.col("__dup_one")).select(*docs.columns)


def _sets_of(docs: DataFrame, classes: DataFrame, posts: DataFrame) -> DataFrame:
    """``node``, ``n``, ``shingles``, ``parity`` of every class that is posted, from the
    text of the document that stands for it."""
    posted = posts.select("node").distinct()
    wanted = classes.join(posted, "node").select("node", "one.doc_id", "one.text_hash")
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["text_hash"] == wanted["text_hash"])
    texts = docs.join(wanted, same).groupBy("node").agg(F.first("text").alias("text"))
    return stored(texts.mapInArrow(_set_rows, "node long, n long, shingles array<long>, parity array<long>"), "sets")


def _confirmed(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with enough equal coordinates whose full sets are similar enough."""
    a = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    b = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    close = pairs.join(a, "a").join(b, "b").select("a", "b", "sketch_a", "sketch_b")
    close = close.mapInArrow(_equal_coordinates, "a long, b long")
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"), F.col("n").alias("n_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"), F.col("n").alias("n_b"))
    both = close.join(a, "a").join(b, "b")
    both = both.withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
    return both.filter(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def _open_lists(sized: DataFrame, sets: DataFrame, roots: DataFrame | None, percent: int) -> DataFrame:
    """The postings that can still give a link: ``post``, ``node``, ``n``,
    ``root``, and ``crossed``, the node's shingles that a set of another
    component has too.

    A link across components lies within these shingles and covers ``percent``
    of either set, so a set with fewer of them is out.  That is exact, and it
    frees the lists from the documents that share a long passage and no more.
    """
    if roots is None:
        rooted = sized.withColumn("root", F.col("node"))
    else:
        rooted = sized.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = F.col("least_root") != F.col("greatest_root")
    span = [F.min("root").alias("least_root"), F.max("root").alias("greatest_root")]
    mixed_lists = rooted.groupBy("post").agg(*span).filter(several).select("post")
    rooted = stored(rooted.join(mixed_lists, "post"), "rooted")
    own = rooted.select("node", "root").distinct()
    shingles = stored(
        own.join(sets.select("node", "shingles"), "node").select("node", "root", F.explode("shingles").alias("shingle")),
        "shingles",
    )
    across = shingles.groupBy("shingle").agg(*span).filter(several).select("shingle")
    crossed = shingles.join(across, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("crossed"))
    rooted = rooted.join(crossed, "node").filter(100 * F.col("crossed") >= percent * F.col("n"))
    return stored(rooted, "open_lists")


def _links(sketches: DataFrame, posts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links between sets that are not in one component by other links."""
    sized = posts.join(sets.select("node", "n"), "node")
    lists = _open_lists(sized, sets, None, percent)
    # Each list against its first member and that with the largest part in common with others.
    common = F.struct((F.col("crossed") / F.col("n")).alias("part"), "node")
    centres = lists.groupBy("post").agg(F.min("node").alias("first"), F.max(common).alias("most"))
    star = lists.select("node", "post").join(
        centres.select("post", F.explode(F.array("first", "most.node")).alias("centre")), "post"
    )
    pair = F.struct(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    star = star.filter("node <> centre").select(pair.alias("p")).select("p.a", "p.b").distinct()
    star = stored(star, "star")
    first = stored(_confirmed(star, sketches, sets, percent), "links")
    # What is left are pairs across components.  The smaller set of a link has
    # two shares of the overlap to show where the larger has one of each.
    lists = _open_lists(sized, sets, components(first), percent).join(sets.select("node", "parity"), "node")
    smaller = lists.filter((100 + percent) * F.col("crossed") >= 2 * percent * F.col("n")).alias("x")
    y = lists.alias("y")
    total = F.col("x.n") + F.col("y.n")
    apart = sum(F.bit_count(F.get("x.parity", F.lit(i)).bitwiseXOR(F.get("y.parity", F.lit(i)))) for i in range(PARITY_BITS // 64))
    across = smaller.join(
        y,
        (F.col("x.post") == F.col("y.post"))
        & (F.struct("x.n", "x.node") < F.struct("y.n", "y.node"))
        & (F.col("x.root") != F.col("y.root"))
        & ((100 + percent) * F.least("x.crossed", "y.crossed") >= percent * total)
        & ((100 + percent) * (total - apart) >= 2 * percent * total),
    )
    pair = F.struct(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    across = across.select(pair.alias("p")).select("p.a", "p.b").distinct()
    rest = across.join(star, ["a", "b"], "left_anti")
    return stored(first.unionAll(_confirmed(rest, sketches, sets, percent)), "links")
