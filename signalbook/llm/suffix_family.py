"""Removal of long passages that stand elsewhere too, by a logarithmic family
of suffix arrays.

A window is a string of ``LENGTH`` bytes.  Of all suffixes of a text only some
are kept: the first smallest gram of a window is its anchor, and the windows
of one anchor whose starts lie in one cell of a grid share a core, the suffix
that the cell is named by.  Equal windows have equal anchors, cells and cores
wherever they stand, so windows are equal only if their kept suffixes agree
over the core.  An entry of a suffix array is such a suffix:

``suffix``  its first bytes and a fingerprint of the core, the sort key
``around``  a fingerprint of all bytes that the windows of the cell cover here
``first``, ``last``  the starts of these windows in the text
``k1``, ``k2``  the row: its id and a fingerprint of its text

Documents come in batches.  A batch is sorted into a suffix array and
merge-scanned with each level of the family: neighbours that agree are long
matches.  Levels of equal size become one level, as in binary counting, and
that merge is the scan.  Two entries that agree in ``suffix`` and ``around``
repeat all their windows; of two that agree in ``suffix`` alone, the windows
are compared one by one, in a last suffix array of whole windows.

Arrays are range-partitioned by their key and a random number, so a passage
that a third of all documents share is spread over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbook.llm.store import removed, shuffles_freed, slices, stored
from signalbook.session import new_dir

LENGTH = 400
#: Bytes of a gram; a window's anchor is the first of its smallest grams.
GRAM = 32
#: Starts of windows that one entry may stand for.
GRID = 128
BATCHES = 4
#: Bytes that a task looks at together.
_CHUNK = 1 << 20
_POSITION = np.uint64((1 << 21) - 1)
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

#: What a scan finds of an entry.
APART, TWICE = 1, 2  # its core stands elsewhere with another surrounding; the whole entry does

ENTRY = "suffix long, around long, salt short, k1 long, k2 long, first int, last int, found byte"
_TYPES = [pa.int64(), pa.int64(), pa.int16(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int8()]
_NAMES = [field.split()[0] for field in ENTRY.split(", ")]
#: The first and the last entry of a task's share of an array.
_FRONT, _BACK = 1, 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Fingerprints of the substrings of some bytes, by two polynomials."""

    _powers: dict[tuple[int, int], np.ndarray] = {}

    def __init__(self, data: np.ndarray) -> None:
        self.sums = []
        values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIERS[0]))[data]
        for base in _MULTIPLIERS:
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values * self._power(base, len(data)), out=sums[1:])
            self.sums.append(sums)

    @classmethod
    def _power(cls, base: int, n: int) -> np.ndarray:
        held = cls._powers.get((base, 0), np.zeros(0, np.uint64))
        if len(held) < n:
            held = np.full(max(n, _CHUNK + 4 * LENGTH), base, np.uint64)
            held[0] = 1
            held = cls._powers[base, 0] = np.cumprod(held)
        return held[:n]

    def of(self, which: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = self._power(pow(_MULTIPLIERS[which], -1, 1 << 64), len(self.sums[which]))
        sums = self.sums[which]
        return _mixed((sums[end] - sums[begin]) * inverse[begin])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    blocks = np.pad(values, (0, -len(values) % width), constant_values=np.iinfo(values.dtype).max).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def sampled(data: np.ndarray, ends: np.ndarray, length: int, gram: int, grid: int) -> dict[str, np.ndarray]:
    """The entries of texts that stand one after the other in ``data`` and stop
    at ``ends``; ``first`` and ``last`` count from the beginning of ``data``."""
    n = len(data) - length + 1
    if n <= 0:
        return {c: np.zeros(0, np.int64) for c in ("text", "first", "last", "suffix", "around")}
    hashes = Hashes(data)
    at = np.arange(len(data) - gram + 1)
    order = hashes.of(0, at, at + gram) & ~_POSITION | at.astype(np.uint64)
    anchor = (_smallest(order, length - gram + 1) & _POSITION).astype(np.int64)
    text = np.searchsorted(ends, np.arange(n), side="right")
    start = np.flatnonzero(np.arange(n) + length <= ends[text])
    cell = (anchor[start] - start) // grid
    core = anchor[start] - cell * grid
    new = np.r_[True, (np.diff(core) != 0) | (np.diff(start) != 1)] if len(start) else np.zeros(0, bool)
    first = start[new]
    last = start[np.r_[np.flatnonzero(new)[1:] - 1, len(start) - 1]] if len(start) else first
    core = core[new]
    sign = np.uint64(1 << 63)
    head = np.zeros(len(core), np.uint64)
    for k in range(3):
        head = head << np.uint64(8) | data[core + k].astype(np.uint64)
    suffix = head << np.uint64(40) | hashes.of(0, core, core + length - grid + 1) >> np.uint64(24)
    shape = ((core - first) * grid + (core - last)).astype(np.uint64)
    around = _mixed(hashes.of(1, first, last + length) ^ _mixed(shape + np.uint64(1)))
    return {
        "text": text[first], "first": first, "last": last,
        "suffix": (suffix ^ sign).view(np.int64), "around": around.view(np.int64),
    }


def _entry_batch(rng, suffix, around, k1, k2, first, last) -> pa.RecordBatch:
    salt = rng.integers(-(1 << 15), 1 << 15, len(suffix))
    columns = (suffix, around, salt, k1, k2, first, last, np.zeros(len(suffix)))
    arrays = [pa.array(np.asarray(c).astype(t.to_pandas_dtype()), t) for c, t in zip(columns, _TYPES, strict=True)]
    return pa.record_batch(arrays, names=_NAMES)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each of them stops."""
    binary = column.cast(pa.large_binary())
    bounds = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds[1:] - bounds[0]


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("k1").to_numpy(), batch.column("k2").to_numpy()


def _entries(length: int, gram: int, grid: int):
    """A ``mapInArrow`` function: the entries of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for batch in slices(batches, "text", _CHUNK):
            data, ends = _bytes_of(batch.column("text"))
            k1, k2 = _keys(batch)
            starts = np.r_[0, ends[:-1]]
            for begin in range(0, max(1, len(data)), _CHUNK):
                # Only a long text, a slice of its own, takes more than one turn.
                part = data[begin : begin + _CHUNK + length - 1]
                found = sampled(part, np.minimum(ends - begin, len(part)), length, gram, grid)
                text = found["text"]
                shift = begin - starts[text]
                yield _entry_batch(
                    rng, found["suffix"], found["around"], k1[text], k2[text],
                    found["first"] + shift, found["last"] + shift,
                )

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of a task, in order, with what their neighbours tell.  The
    last entry so far is held back until its successor is known."""
    part = TaskContext.get().partitionId()

    def marked(table: pa.Table, edge: np.ndarray) -> pa.RecordBatch:
        table = table.append_column("edge", pa.array(edge, pa.int8()))
        table = table.append_column("part", pa.array(np.full(len(edge), part), pa.int32()))
        return table.combine_chunks().to_batches()[0]

    held, front = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        table = new if held is None else pa.concat_tables([held, new])
        suffix, around = (table.column(c).to_numpy() for c in ("suffix", "around"))
        same = suffix[1:] == suffix[:-1]
        both = same & (around[1:] == around[:-1])
        told = np.where(both, TWICE, np.where(same, APART, 0)).astype(np.int8)
        found = table.column("found").to_numpy().copy()
        found[1:] |= told
        found[:-1] |= told
        table = table.set_column(table.schema.get_field_index("found"), "found", pa.array(found, pa.int8()))
        held, done = table.slice(len(found) - 1), table.slice(0, len(found) - 1)
        if done.num_rows:
            edge = np.zeros(done.num_rows, np.int8)
            edge[0] = _FRONT if front else 0
            front = False
            yield marked(done, edge)
    if held is not None:
        yield marked(held, np.array([_BACK | (_FRONT if front else 0)], np.int8))


def scanned(entries: DataFrame, only_found: bool = False) -> tuple[DataFrame, DataFrame, str]:
    """``entries`` as one suffix array, each with what its neighbours in it
    tell, stored; what neighbours in different tasks tell, as a small table;
    and the folder.  With ``only_found``, entries that nothing was found of are
    left out."""
    spark = entries.sparkSession
    order = ["suffix", "around", "salt"]
    rows = entries.select(*_NAMES).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.mapInArrow(_neighbours, f"{ENTRY}, edge byte, part int")
    if only_found:
        rows = rows.filter("found > 0 or edge > 0")
    path = new_dir(spark, "suffixes")
    with shuffles_freed(spark):
        rows.write.parquet(path)
    array = spark.read.schema(rows.schema).parquet(path)
    # Two entries per task, in the order of the array.
    edges = array.filter("edge > 0").orderBy("part", "edge").collect()
    fixes = []
    for a, b in zip(edges, edges[1:], strict=False):
        if a.part != b.part and a.suffix == b.suffix:
            what = TWICE if a.around == b.around else APART
            fixes += [tuple(e[c] for c in _NAMES[:-1]) + (what,) for e in (a, b)]
    return array, spark.createDataFrame(fixes, ENTRY), path


class Family:
    """Levels of suffix arrays; level ``i`` holds ``2 ** i`` batches."""

    def __init__(self) -> None:
        self.levels: dict[int, tuple[DataFrame, str]] = {}
        self.matches: list[DataFrame] = []
        self.folders: list[str] = []

    def add(self, batch: DataFrame) -> None:
        """Takes the entries of a batch in, and finds their long matches among
        themselves and with all batches before."""
        size, merged = 0, []
        while size in self.levels:
            merged.append(self.levels.pop(size))
            size += 1
        for level, _ in self.levels.values():
            matches, fixes, path = scanned(batch.unionByName(level.select(*_NAMES)), only_found=True)
            self.matches += [matches.select(*_NAMES), fixes]
            self.folders.append(path)
        rows = batch
        for level, _ in merged:
            rows = rows.unionByName(level.select(*_NAMES))
        array, fixes, path = scanned(rows)
        self.matches.append(fixes)
        self.levels[size] = array, path
        for _, old in merged:
            removed(batch.sparkSession, old)

    def found(self) -> DataFrame:
        """``k1``, ``k2``, ``first``, ``last``, ``found`` of the entries with a match, once each."""
        rows = [level for level, _ in self.levels.values()] + self.matches
        columns = ["k1", "k2", "first", "last"]
        out = rows[0].select(*columns, "found")
        for more in rows[1:]:
            out = out.unionAll(more.select(*columns, "found"))
        return out.filter("found > 0").groupBy(*columns).agg(F.bit_or("found").alias("found"))

    def remove(self, spark: SparkSession) -> None:
        """Deletes the arrays, once what was found is stored elsewhere."""
        for path in [path for _, path in self.levels.values()] + self.folders:
            removed(spark, path)
        self.levels, self.matches, self.folders = {}, [], []


def covered(starts: np.ndarray, lasts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the windows starting in these ranges cover."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    begin, end = starts[order], np.maximum.accumulate(lasts[order] + length)
    new = np.r_[True, begin[1:] > end[:-1]]
    return list(zip(begin[new].tolist(), end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]].tolist(), strict=True))


_VERDICT = "doc_id long, k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _verdicts(batch: pa.RecordBatch, runs: list[list[tuple[int, int]]], spans: bool) -> pa.RecordBatch:
    data, ends = _bytes_of(batch.column("text"))
    n_removed, digests = [], []
    for begin, end, own in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), runs, strict=True):
        digest, at = hashlib.sha256(), begin
        for a, b in own:
            digest.update(data[at : begin + a])
            at = begin + b
        digest.update(data[at:end])
        digests.append(digest.hexdigest())
        n_removed.append(sum(b - a for a, b in own))
    columns = {
        "doc_id": batch.column("doc_id"), "k1": batch.column("k1"), "k2": batch.column("k2"),
        "n_bytes": pa.array(np.diff(np.r_[0, ends]).astype(np.int64)), "n_removed": pa.array(n_removed, pa.int64()),
        "n_spans": pa.array([len(r) for r in runs], pa.int64()), "kept_sha256": pa.array(digests, pa.string()),
    }
    if spans:
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        columns["spans"] = pa.array([[{"begin": a, "end": b} for a, b in r] for r in runs], kind)
    return pa.record_batch(list(columns.values()), names=list(columns))


def _ranges(column: pa.Array) -> list[np.ndarray]:
    """Of each row of an array of structs, its fields as columns; none of a null."""
    bounds = column.offsets.to_numpy()
    values = column.values
    wide = np.stack([f.to_numpy(zero_copy_only=False).astype(np.int64) for f in values.flatten()], axis=1)
    return [wide[a:b] if ok else wide[:0] for a, b, ok in
            zip(bounds[:-1], bounds[1:], column.is_valid().to_pylist(), strict=True)]


def _judged(length: int):
    """Verdicts of the texts whose entries all speak for themselves; of the
    others, the text and its entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _CHUNK):
            entries = _ranges(batch.column("entries"))
            runs, todo = [], []
            for e in entries:
                twice = e[(e[:, 2] & TWICE) > 0]
                runs.append(covered(twice[:, 0], twice[:, 1], length))
                todo.append(bool((e[:, 2] & APART).any()))
            out = _verdicts(batch, runs, spans=True)
            kept = pa.array([i if open_ else None for i, open_ in enumerate(todo)], pa.int64())
            for name in ("text", "entries"):
                out = out.append_column(name, batch.column(name).take(kept))
            yield out

    return run


def _windows(length: int):
    """The windows of the entries that are still open, as entries of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for batch in slices(batches, "text", _CHUNK):
            data, ends = _bytes_of(batch.column("text"))
            k1, k2 = _keys(batch)
            begins = np.r_[0, ends[:-1]]
            rows, starts = [], []
            for i, e in enumerate(_ranges(batch.column("entries"))):
                e = e[(e[:, 2] & APART) > 0]
                sizes = e[:, 1] - e[:, 0] + 1
                inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                starts.append(np.unique(np.repeat(e[:, 0], sizes) + inner) + begins[i])
                rows.append(np.full(len(starts[-1]), i))
            row, start = np.concatenate(rows), np.concatenate(starts)
            for begin in range(0, len(data), _CHUNK):
                own = (start >= begin) & (start < begin + _CHUNK)
                if not own.any():
                    continue
                hashes = Hashes(data[begin : begin + _CHUNK + length - 1])
                at, i = start[own] - begin, row[own]
                place = start[own] - begins[i]
                one, two = (hashes.of(k, at, at + length).view(np.int64) for k in (0, 1))
                yield _entry_batch(rng, one, two, k1[i], k2[i], place, place)

    return run


def _finished(length: int):
    """Verdicts from the runs known before and the windows found since."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _CHUNK):
            runs = []
            for known, more in zip(_ranges(batch.column("spans")), batch.column("starts").to_pylist(), strict=True):
                starts = np.array(more or [], np.int64)
                begin = np.r_[known[:, 0], starts]
                runs.append(covered(begin, np.r_[known[:, 1] - length, starts], length))
            yield _verdicts(batch, runs, spans=True)

    return run


def repeated_passages(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, grid: int = GRID, batches: int = BATCHES
) -> DataFrame:
    """Each row of ``docs`` (``doc_id``, ``text``) with the bytes of its UTF-8
    text that a string of ``length`` bytes covers which also starts elsewhere,
    in its own text or another: ``n_bytes``, ``n_removed``, ``spans`` (the
    maximal runs, begin and end), ``n_spans`` and ``kept_sha256`` of the rest.

    A null text is empty; a text shorter than ``length`` keeps every byte.
    Rows that repeat an id count like others, so do fully equal ones, and
    null ids; a text may be as long as a column can hold.  Other columns are
    not read.  An empty table gives an empty one.  Strings are compared by 128
    bits of fingerprints.
    """
    if not 0 < gram <= length - grid + 1 or grid > 256 or length - grid < 3:
        raise ValueError("the core of a cell, length - grid + 1 bytes, must hold a gram")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", text.alias("text"),
        F.coalesce("doc_id", F.lit(-(1 << 63))).cast("bigint").alias("k1"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("k2"),
    )
    spark = docs.sparkSession
    path = new_dir(spark, "entries")
    entries = rows.select("text", "k1", "k2").mapInArrow(_entries(length, gram, grid), ENTRY)
    entries.withColumn("batch", F.pmod("k2", F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(path)
    entries = spark.read.schema(f"{ENTRY}, batch int").parquet(path)
    family = Family()
    for number in range(batches):
        family.add(entries.filter(F.col("batch") == number).select(*_NAMES))
    removed(spark, path)

    of_text = F.collect_list(F.struct("first", "last", F.col("found").cast("int").alias("found")))
    matched = family.found().groupBy("k1", "k2").agg(of_text.alias("entries"))
    judged = rows.join(matched, ["k1", "k2"], "left").mapInArrow(
        _judged(length),
        f"{_VERDICT}, spans array<struct<begin:int,end:int>>, text string, "
        "entries array<struct<first:int,last:int,found:int>>",
    )
    with shuffles_freed(spark):
        judged = stored(judged, "judged")
    family.remove(spark)
    open_ = judged.filter("text is not null")
    windows, fixes, _ = scanned(open_.mapInArrow(_windows(length), ENTRY), only_found=True)
    again = windows.select(*_NAMES).unionByName(fixes).filter(F.col("found").bitwiseAND(TWICE) > 0)
    again = again.select("k1", "k2", "first").distinct().groupBy("k1", "k2").agg(F.collect_list("first").alias("starts"))
    finished = open_.join(again, ["k1", "k2"], "left").mapInArrow(
        _finished(length), f"{_VERDICT}, spans array<struct<begin:int,end:int>>"
    )
    out = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    return judged.filter("text is null").select(*out).unionAll(finished.select(*out))
