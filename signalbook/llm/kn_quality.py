"""Perplexity of documents under an interpolated modified Kneser-Ney model of
subwords, trained on trusted text.

A text is one character per subword of a public vocabulary; everything after
that counts characters.  An n-gram of four is one number.

Texts are stored in blocks, as their characters.  All n-grams with the same
third character are counted and asked for in the same pass over the blocks, so
only a share of them is on disk at a time, and in the same bucket of it, where
the counts of orders 4, 3 and 2 are made and every question is answered; what
goes back is a sum per row and bucket.  A frequent character's n-grams are
dealt to several buckets by the character before it, and the pairs it begins,
which only all of them can count, are summed up first.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cached_property, reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.llm.packing import encoding
from signalbook.llm.store import shuffles_freed, slices, stored

ORDER = 4
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The subword with number 0 is this character; white space and ``PAD`` are below.
_FIRST = 256
#: Bits of a character in the number of an n-gram.
_BITS = 16
#: So many different letters or pairs still have a table of their squares.
_FEW = 4096
#: Stands before the first character of a text.
PAD = "\x02"
#: Of the trusted documents, one in ``FOLDS`` is not trained on and sets the thresholds.
FOLDS = 5
QUANTILE = 0.995
#: Trusted ids up to this many are broadcast, about 64 MB; more are joined by shuffle.
BROADCAST_ROWS = 4_000_000
_PLACES = 1 << 21  # code points end below
#: The n-grams are counted and asked for in so many passes, so that a share of them is on disk at a time.
PASSES = 8
#: Windows of a pass, if fewer passes do.
LEAST_PASS = 1 << 22
#: Windows of a bucket, and what a smaller one holds at least, if there are fewer than ``FEW_BUCKETS``.
BUCKET, LEAST_BUCKET, FEW_BUCKETS = 1 << 20, 1 << 15, 24
#: Bytes of text in a block, and windows that a task looks at together.
_SLICE, _CHUNK = 1 << 22, 1 << 20


class Grams:
    """The n-grams of a column of texts, by number.  ``keys[i]`` is the n-gram
    that ends at the i-th character, ``sizes`` the characters per text.  White
    space counts as one blank per run.

    An n-gram is two pairs of characters; the pairs that occur are numbered,
    so a pair of pairs is a place in a small table, and counting and looking
    up need no sort.
    """

    def __init__(self, texts: pa.Array) -> None:
        plain = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), r"[\s\x00\x02]+", " ")
        self.sizes = pc.utf8_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)
        pads = PAD * (ORDER - 1)
        codes = np.frombuffer((pads + "".join(text + pads for text in plain.to_pylist())).encode("utf-32-le"), dtype=np.uint32)
        self.codes = codes

    @cached_property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    @cached_property
    def letters(self) -> np.ndarray:
        present = np.zeros(_PLACES, bool)
        present[self.codes] = True
        return np.flatnonzero(present).astype(np.uint32)

    @cached_property
    def _numbered(self) -> tuple[np.ndarray, np.ndarray]:
        rank = np.zeros(_PLACES, np.int64)
        rank[self.letters] = np.arange(len(self.letters))
        letter = rank[self.codes]
        pairs = letter[:-1] * len(self.letters) + letter[1:]
        if len(self.letters) > _FEW:
            return np.unique(pairs, return_inverse=True)
        used = np.zeros(len(self.letters) ** 2, bool)
        used[pairs] = True
        return np.flatnonzero(used), (np.cumsum(used) - 1)[pairs]

    @property
    def pairs(self) -> np.ndarray:
        return self._numbered[0]

    @property
    def direct(self) -> bool:
        return len(self.pairs) <= _FEW

    @cached_property
    def keys(self) -> np.ndarray:
        pairs = self._numbered[1]
        # A text's windows begin at its pads, which are shared with no other text.
        starts = np.arange(len(self.rows)) + self.rows * (ORDER - 1)
        return pairs[starts] * len(self.pairs) + pairs[starts + 2] if len(starts) else np.zeros(0, np.int64)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams that occur and how often."""
        if not self.direct:
            return np.unique(self.keys, return_counts=True)
        n = np.bincount(self.keys, minlength=1)
        keys = np.flatnonzero(n)
        return keys, n[keys]

    def _columns(self, keys: np.ndarray) -> list[np.ndarray]:
        ends = self.pairs[keys // len(self.pairs)], self.pairs[keys % len(self.pairs)]
        return [self.letters[x] for pair in ends for x in (pair // len(self.letters), pair % len(self.letters))]

    def spelled(self, keys: np.ndarray) -> list[str]:
        if not len(keys):
            return []
        return np.stack(self._columns(keys), axis=1).astype("<u4").view(f"<U{ORDER}").ravel().tolist()

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The n-grams as numbers, their last character in the lowest bits."""
        if not len(keys):
            return np.zeros(0, np.int64)
        if int(self.letters[-1]) >> _BITS:
            raise ValueError(f"a character needs more than {_BITS} bits")
        out = np.zeros(len(keys), np.uint64)
        for column in self._columns(keys):
            out = out << np.uint64(_BITS) | column.astype(np.uint64)
        return out.view(np.int64)

    def looked_up(self, grams: list[str] | np.ndarray, values: np.ndarray) -> np.ndarray:
        """The value of the n-gram at every character; NaN where it is not given."""
        if not len(self.keys):
            return np.zeros(0)
        codes = np.array(grams, dtype=f"<U{ORDER}").view("<u4").reshape(-1, ORDER)
        letter = np.searchsorted(self.letters, codes)
        ends = [np.searchsorted(self.pairs, letter[:, k] * len(self.letters) + letter[:, k + 1]) for k in (0, 2)]
        keys = ends[0] * len(self.pairs) + ends[1]
        if self.direct:
            table = np.full(len(self.pairs) ** 2, np.nan)
            table[keys] = values
            return table[self.keys]
        order = np.argsort(keys)
        place = np.minimum(np.searchsorted(keys[order], self.keys), max(0, len(keys) - 1))
        return np.where(keys[order][place] == self.keys, values[order][place], np.nan) if len(keys) else np.full(len(self.keys), np.nan)


def spelled(numbers: np.ndarray) -> np.ndarray:
    """The n-grams of these numbers as strings."""
    whole = numbers.astype(np.int64).view(np.uint64)
    columns = [whole >> np.uint64(_BITS * k) & np.uint64((1 << _BITS) - 1) for k in range(ORDER - 1, -1, -1)]
    return np.stack(columns, axis=1).astype("<u4").view(f"<U{ORDER}").ravel()


class Plan:
    """Which pass and which bucket of it the n-grams go to.  Those with the same
    third of four characters share a pass, and a bucket too unless it is so
    frequent that its n-grams are dealt to several by their second one."""

    def __init__(self, counts: np.ndarray) -> None:
        total = max(1, int(counts.sum()))
        self.n_passes = min(PASSES, -(-total // LEAST_PASS))
        share = -(-total // self.n_passes)
        self.buckets = max(-(-share // BUCKET), min(FEW_BUCKETS, -(-share // LEAST_BUCKET)))
        size = -(-share // self.buckets)
        self.splits = np.minimum(np.maximum(1, -(-counts // size)), self.buckets).astype(np.int32)
        self.passes = np.zeros(len(counts), np.int8)
        held = [(0, i) for i in range(self.n_passes)]
        for c in np.argsort(-counts, kind="stable").tolist():
            n, i = heapq.heappop(held)
            self.passes[c] = i
            heapq.heappush(held, (n + int(counts[c]), i))

    def bucket(self, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (_mixed(c) + _mixed(b) % self.splits[c]) % self.buckets


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(33)).astype(np.int64)


def _packed(*columns: np.ndarray, level: int = 1) -> bytes:
    """Whole numbers, column by column."""
    data = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", level).compress(data, asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _packed_grams(keys: np.ndarray, values: np.ndarray) -> bytes:
    parts = [(keys >> np.uint64(s)).astype(np.uint16) for s in (48, 32, 16, 0)]
    return _packed(*parts, values.astype(np.uint32))


def _unpacked_grams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    whole = _unpacked(data)
    n = len(whole) // 12
    parts = np.frombuffer(whole, np.uint16, 4 * n).reshape(4, n).astype(np.uint64)
    keys = parts[0] << np.uint64(48) | parts[1] << np.uint64(32) | parts[2] << np.uint64(16) | parts[3]
    return keys, np.frombuffer(whole, np.uint32, n, 8 * n)


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of texts, with pads before, between and after them, and how many each has."""
    grams = Grams(texts)
    return grams.sizes, grams.codes


def _subwords():
    """A function that does the same with one character per subword; white space counts as one blank per run."""
    encode = encoding(public_tokenizers.path(VOCABULARY)).encode_ordinary
    pads = np.full(ORDER - 1, ord(PAD), np.uint32)

    def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), r"[\s\x00\x02]+", " ")
        ids = [np.array(encode(text), dtype=np.uint32) + _FIRST for text in plain.to_pylist()]
        return np.array([len(i) for i in ids], np.int64), np.concatenate([pads, *(x for i in ids for x in (i, pads))])

    return run


def _blocks(subwords: bool):
    """A ``mapInArrow`` function: blocks of documents, their rows' columns and all their characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        characters = _subwords() if subwords else _characters
        for i, batch in enumerate(slices(batches, "text", _SLICE)):
            sizes, codes = characters(batch.column("text"))
            if int(codes.max()) >> _BITS:
                raise ValueError(f"a character needs more than {_BITS} bits")
            lists = [pa.array([batch.column(c).to_pylist()], pa.list_(t)) for c, t in _ROW.items()]
            # All passes read the characters, so they are worth a better compression.
            whole = _packed(sizes), _packed(codes.astype(np.uint16), level=6)
            data = [pa.array([x], pa.binary()) for x in whole]
            yield pa.record_batch([pa.array([part + i]), *lists, *data], names=["block", *_ROW, "sizes", "codes"])

    return run


_ROW = {"doc_id": pa.int64(), "lang": pa.string(), "held": pa.bool_()}
_BLOCK = "block long, doc_id array<long>, lang array<string>, held array<boolean>, sizes binary, codes binary"


def _codes(batch: pa.RecordBatch, at: int) -> np.ndarray:
    return np.frombuffer(_unpacked(batch.column("codes")[at].as_py()), np.uint16)


def _windows(codes: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Where the windows begin whose third character is marked in ``third``; the last one is a text's."""
    return np.flatnonzero(third[codes[2:-1]] & (codes[3:] != ord(PAD)))


def _thirds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many windows have a character in the third place."""
    for batch in batches:
        for at in range(batch.num_rows):
            codes = _codes(batch, at)
            n = np.bincount(codes[2:-1][codes[3:] != ord(PAD)], minlength=1)
            own = np.flatnonzero(n)
            yield pa.record_batch([pa.array(own), pa.array(n[own])], names=["c", "n"])


#: What a row of a bucket holds; they are read in this order.
_SHIPPED, _TRAINED, _ASKED = 0, 1, 2
_SENT = "bucket int, kind byte, block long, grams binary"


def _sent(plan: Plan, number: int, ask: bool):
    """A ``mapInArrow`` function: the n-grams of pass ``number``, by bucket:
    those trained on with their counts, and if asked for, all with their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = plan.passes == number
        for batch in batches:
            for at in range(batch.num_rows):
                codes = _codes(batch, at)
                sizes = np.frombuffer(_unpacked(batch.column("sizes")[at].as_py()), np.int64)
                trained = np.array([h is False for h in batch.column("held")[at].as_py()], bool)
                if not ask and not trained.any():
                    continue
                own = _windows(codes, mine)
                begins = np.cumsum(sizes + ORDER - 1) - sizes - (ORDER - 1)
                per_row = np.diff(np.searchsorted(own, np.r_[begins, len(codes)]))
                rows = np.repeat(np.arange(len(sizes), dtype=np.uint32), per_row)
                if not ask:
                    own, rows = own[trained[rows]], rows[trained[rows]]
                block, out = batch.column("block")[at].as_py(), []
                for begin in range(0, len(own), _CHUNK):
                    place = own[begin : begin + _CHUNK]
                    a, b, c, d = (codes[place + k].astype(np.uint64) for k in range(ORDER))
                    keys = c << np.uint64(48) | b << np.uint64(32) | a << np.uint64(16) | d
                    order = np.argsort(keys)
                    bucket = plan.bucket(b[order], c[order].astype(np.int64))
                    if plan.buckets > 1:
                        by_bucket = np.argsort(bucket.astype(np.min_scalar_type(plan.buckets)), kind="stable")
                        order, bucket = order[by_bucket], bucket[by_bucket]
                    keys, row = keys[order], rows[begin : begin + _CHUNK][order]
                    cuts = np.flatnonzero(np.diff(bucket)) + 1
                    for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
                        known = keys[i:j][trained[row[i:j]]]
                        if len(known):
                            new = np.flatnonzero(np.r_[True, known[1:] != known[:-1]])
                            n = np.diff(np.r_[new, len(known)])
                            out.append((int(bucket[i]), _TRAINED, block, _packed_grams(known[new], n)))
                        if ask:
                            out.append((int(bucket[i]), _ASKED, block, _packed_grams(keys[i:j], row[i:j])))
                if out:
                    kinds = (pa.int32(), pa.int8(), pa.int64(), pa.binary())
                    columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.record_batch(columns, names=[f.split()[0] for f in _SENT.split(", ")])

    return run


def _merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its numbers."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[new], np.add.reduceat(n[order], new)


def _without(keys: np.ndarray, which: int) -> np.ndarray:
    """The keys without the 16 bits that stand above ``which`` lower ones."""
    low = np.uint64((1 << which) - 1)
    return keys >> np.uint64(which + _BITS) << np.uint64(which) | keys & low


class Counts:
    """The counts of one bucket by order: n-grams as numbers, of which the last
    character is lowest and the one before it highest, and how often each."""

    def __init__(self, trained: list[bytes], shipped: list[bytes], splits: np.ndarray) -> None:
        found = [_unpacked_grams(x) for x in trained]
        keys = np.concatenate([k for k, _ in found] or [np.zeros(0, np.uint64)])
        self.of = {4: _merged(keys, np.concatenate([n for _, n in found] or [np.zeros(0, np.uint32)]).astype(np.int64))}
        for k in (3, 2):
            # Lower orders count the different characters before an n-gram, which stand above its last one.
            shorter = _without(self.of[k + 1][0], _BITS)
            self.of[k] = _merged(shorter, np.ones(len(shorter), np.int64))
        keys, n = self.of[2]
        #: The pairs whose first character is in other buckets too; only all of them know the sum.
        part = splits[(keys >> np.uint64(_BITS)).astype(np.int64)] > 1
        self.partial = keys[part], n[part]
        whole = [_unpacked_grams(x) for x in shipped]
        keys = np.concatenate([keys[~part], *(k for k, _ in whole)])
        self.of[2] = _merged(keys, np.concatenate([n[~part], *(m for _, m in whole)]).astype(np.int64))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "block", "grams")), strict=True)


#: Kinds of statistics: counts of counts by order, pairs by their last character, pairs of a split character.
_OF_COUNTS, _SINGLES, _PAIRS = 0, 1, 2


def _statistics(plan: Plan):
    """A ``mapInArrow`` function: what the buckets add to the counts of counts and to the counts they share."""

    def told(trained: list[bytes]) -> pa.RecordBatch:
        counts, out = Counts(trained, [], plan.splits), []
        for k in (4, 3, 2):
            n = np.bincount(np.minimum(counts.of[k][1], 5), minlength=6)[1:5]
            out.append((np.full(4, _OF_COUNTS), np.full(4, k), np.arange(1, 5), n))
        last = np.bincount((counts.of[2][0] & np.uint64(0xFFFF)).astype(np.int64), minlength=1)
        own = np.flatnonzero(last)
        out.append((np.full(len(own), _SINGLES), np.zeros(len(own), int), own, last[own]))
        keys, n = counts.partial
        pair = (keys >> np.uint64(_BITS)).astype(int), (keys & np.uint64(0xFFFF)).astype(int)
        out.append((np.full(len(keys), _PAIRS), *pair, n))
        return pa.record_batch(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out, strict=True)], names=["kind", "c", "d", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_buckets(batches), lambda r: r[0]):
            yield told([r[3] for r in rows])

    return run


class Model:
    """The discounts of every order and the probabilities of single characters."""

    def __init__(self, of_counts: dict[int, list[int]], singles: np.ndarray) -> None:
        self.discounts = {k: discounts(*of_counts[k]) for k in of_counts}
        some = [int((singles == c).sum()) for c in (1, 2, 3, 4)]
        self.discounts[1] = discounts(*some)
        letters, total = int((singles > 0).sum()) + 1, int(singles.sum())
        off = self.discount(1, singles)
        share = off[singles > 0].sum() / total if total else 1.0
        self.single = np.where(singles > 0, singles - off, 0.0) / max(1, total) + share / letters

    def discount(self, k: int, n: np.ndarray) -> np.ndarray:
        one, two, more = self.discounts[k]
        return np.where(n == 1, one, np.where(n == 2, two, more))

    def log_probabilities(self, counts: Counts):
        """A function from n-grams, in order, to the logarithms of their last character's probability."""
        tables = []
        for k in (2, 3, 4):
            keys, n = counts.of[k]
            context = keys >> np.uint64(_BITS)
            new = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.zeros(0, np.int64)
            off = self.discount(k, n)
            total = np.add.reduceat(n, new) if len(keys) else np.zeros(0)
            share = np.add.reduceat(off, new) / total if len(keys) else np.zeros(0)
            tables.append((k, keys, n - off, context[new], total, share))

        def of(keys: np.ndarray) -> np.ndarray:
            p = self.single[(keys & np.uint64(0xFFFF)).astype(np.int64)]
            shorter = {4: keys, 3: _without(keys, _BITS)}
            shorter[2] = _without(shorter[3], _BITS)
            for k, grams, kept, contexts, total, share in tables:
                if not len(grams):
                    continue
                own = shorter[k]
                i = np.minimum(np.searchsorted(contexts, own >> np.uint64(_BITS)), len(contexts) - 1)
                known = contexts[i] == own >> np.uint64(_BITS)
                j = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                seen = np.where(grams[j] == own, kept[j], 0.0)
                p = np.where(known, seen / total[i] + share[i] * p, p)
            return np.log(p)

        return of


_ANSWER = "block long, rows binary, sums binary"


def _sums(log_p, asked: list[tuple[int, bytes]]) -> pa.RecordBatch:
    """The answers to the questions of some blocks, asked together."""
    found = [_unpacked_grams(data) for _, data in asked]
    keys = np.concatenate([k for k, _ in found])
    order = np.argsort(keys)
    keys = keys[order]
    new = np.r_[True, keys[1:] != keys[:-1]]
    logs = np.empty(len(keys))
    logs[order] = log_p(keys[new])[np.cumsum(new) - 1]
    out, begin = [], 0
    for (block, _), (_, row) in zip(asked, found, strict=True):
        sums = np.bincount(row, logs[begin : begin + len(row)])
        begin += len(row)
        own = np.unique(row)
        out.append((block, own.astype(np.uint32).tobytes(), sums[own].tobytes()))
    kinds = (pa.int64(), pa.binary(), pa.binary())
    columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)]
    return pa.record_batch(columns, names=["block", "rows", "sums"])


def _answered(plan: Plan, model: Model):
    """A ``mapInArrow`` function: the sums of logarithms by block and row, from buckets in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_buckets(batches), lambda r: r[0]):
            known, log_p, asked, n = {_SHIPPED: [], _TRAINED: []}, None, [], 0
            for _, kind, block, data in rows:
                if kind != _ASKED:
                    known[kind].append(data)
                    continue
                if log_p is None:
                    log_p = model.log_probabilities(Counts(known[_TRAINED], known[_SHIPPED], plan.splits))
                    known = None
                asked.append((block, data))
                n += int.from_bytes(data[:8], "little") // 12
                if n >= _CHUNK // 2:
                    yield _sums(log_p, asked)
                    asked, n = [], 0
            if asked:
                yield _sums(log_p, asked)

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per block: its sums added up."""
    at = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["rows"]])
    sums = np.bincount(at, np.concatenate([np.frombuffer(x, np.float64) for x in rows["sums"]]))
    own = np.unique(at)
    return pd.DataFrame({"block": rows["block"][:1], "rows": [own.tobytes()], "sums": [sums[own].tobytes()]})


def _scored(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    names = ["doc_id", "lang", "held", "n_scored", "perplexity"]
    out = []
    for batch in blocks.to_batches():
        for at in range(batch.num_rows):
            sizes = np.frombuffer(_unpacked(batch.column("sizes")[at].as_py()), np.int64)
            logs = np.zeros(len(sizes))
            for rows, sums in zip(*(answers.column(c).to_pylist() for c in ("rows", "sums")), strict=True):
                logs[np.frombuffer(rows, np.uint32)] += np.frombuffer(sums, np.float64)
            ppl = np.where(sizes > 0, np.exp(-logs / np.maximum(sizes, 1)), np.nan)
            row = [batch.column(c)[at].values.cast(t) for c, t in _ROW.items()]
            out.append(pa.table([*row, pa.array(sizes), pa.array(ppl)], names=names))
    return pa.concat_tables(out)


def _by_bucket(rows: DataFrame, plan: Plan) -> DataFrame:
    return rows.repartition(plan.buckets, "bucket").sortWithinPartitions("bucket", "kind", "block")


def _shipped(plan: Plan):
    """The counts of all pairs of a split character, once for each of its buckets."""

    def run(pairs: pd.DataFrame) -> pd.DataFrame:
        c = int(pairs["c"].iloc[0])
        keys = np.sort(pairs["d"].to_numpy().astype(np.uint64) | np.uint64(c << _BITS))
        n = pairs.sort_values("d")["n"].to_numpy()
        bucket = (_mixed(pairs["c"].to_numpy()[:1]) + np.arange(plan.splits[c])) % plan.buckets
        out = pd.DataFrame({"bucket": bucket, "kind": _SHIPPED, "block": -1, "grams": _packed_grams(keys, n)})
        return out.assign(**{"pass": int(plan.passes[c])})

    return run


def _fitted(blocks: DataFrame, plan: Plan) -> tuple[Model, DataFrame]:
    """The model, and the pairs that its buckets do not know themselves."""
    parts = []
    for number in range(plan.n_passes):
        sent = blocks.mapInArrow(_sent(plan, number, ask=False), _SENT)
        told = _by_bucket(sent, plan).mapInArrow(_statistics(plan), "kind long, c long, d long, n long")
        parts.append(stored(told.groupBy("kind", "c", "d").agg(F.sum("n").alias("n")), "statistics"))
    told = reduce(DataFrame.unionAll, parts)
    # Sums over all passes; a pair is in one pass only.
    pairs = told.filter(F.col("kind") == _PAIRS).select("c", "d", "n")
    number_of = F.count("*").alias("n")
    kind, order = F.lit(_OF_COUNTS).alias("kind"), F.lit(2).alias("c")
    of_pairs = pairs.groupBy(kind, order, F.col("n").alias("d")).agg(number_of)
    last = pairs.groupBy(F.lit(_SINGLES).alias("kind"), F.lit(0).alias("c"), "d").agg(number_of)
    few = told.filter(F.col("kind") != _PAIRS).unionByName(of_pairs.filter("d < 5")).unionByName(last)
    # As many rows as there are characters, at most.
    rows = few.groupBy("kind", "c", "d").agg(F.sum("n").alias("n")).collect()
    of_counts = {k: [0] * 4 for k in (4, 3, 2)}
    singles = np.zeros(1 << _BITS, np.int64)
    for r in rows:
        if r.kind == _OF_COUNTS:
            of_counts[r.c][r.d - 1] = r.n
        else:
            singles[r.d] = r.n
    shipped = pairs.groupBy("c").applyInPandas(_shipped(plan), f"{_SENT}, pass int")
    return Model(of_counts, singles), stored(shipped, "shipped")


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken off counts of one, two, and three or more; where the
    counts of counts do not say, a half."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def perplexities(docs: DataFrame, labels: DataFrame, subwords: bool = False) -> DataFrame:
    """``doc_id``, ``lang``, ``held``, ``n_scored``, ``perplexity`` per row of
    ``docs``, by the characters of ``text``, each of which has at most 16 bits,
    or by its subwords.
    Trusted are the documents that ``labels`` give quality 1 and
    never another; ``held`` marks those of them that the model did not see."""
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1 and doc_id is not null")
    trusted = trusted.select(F.col("doc_id").alias("trusted"))
    if trusted.count() <= BROADCAST_ROWS:
        trusted = F.broadcast(trusted)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) == 0
    docs = docs.select("doc_id", "text", "lang").join(trusted, F.col("doc_id") == F.col("trusted"), "left")
    docs = docs.select("doc_id", "text", "lang", F.when(F.col("trusted").isNotNull(), fold).alias("held"))
    spark = docs.sparkSession
    blocks = stored(docs.mapInArrow(_blocks(subwords), _BLOCK), "blocks")
    read = blocks.select("block", "held", "sizes", "codes")
    thirds = read.mapInArrow(_thirds, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()
    plan = Plan(np.bincount([r.c for r in thirds], [r.n for r in thirds], minlength=1 << _BITS).astype(np.int64))
    with shuffles_freed(spark):
        model, shipped = _fitted(read, plan)
        added = []
        for number in range(plan.n_passes):
            sent = read.mapInArrow(_sent(plan, number, ask=True), _SENT)
            sent = sent.unionByName(shipped.filter(F.col("pass") == number).drop("pass"))
            answers = _by_bucket(sent, plan).mapInArrow(_answered(plan, model), _ANSWER)
            added.append(stored(answers.groupBy("block").applyInPandas(_added, _ANSWER), "sums"))
    sums = reduce(DataFrame.unionAll, added)
    return blocks.drop("codes").groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(
        _scored, "doc_id long, lang string, held boolean, n_scored long, perplexity double"
    )


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``threshold`` and ``kept`` to the perplexities by subwords, of
    which a text has ``n_scored``.

    A language's threshold is the quantile over its held trusted documents; a language without any, null included, takes that of all.
    Without trusted documents nothing is rejected but texts without characters,
    null ones included, which have no perplexity.  Repeated rows are scored and
    returned each, and counted each if they are trusted; a text may be as long
    as a column can hold.  An empty table gives an empty one.
    """
    scored = stored(perplexities(docs, labels, subwords=True), "perplexities")
    scored = scored.withColumn("perplexity", F.when(F.col("n_scored") > 0, F.col("perplexity")))
    held = scored.filter("held and perplexity is not null")
    quantile = F.percentile_approx("perplexity", QUANTILE, 10_000)
    by_lang = held.filter("lang is not null").groupBy("lang").agg(quantile.alias("own"))
    of_all = held.agg(quantile.alias("common")).first().common
    limit = F.coalesce("own", F.lit(of_all).cast("double"))
    fits = F.coalesce(F.col("perplexity") <= limit, F.col("perplexity").isNotNull())
    return scored.join(by_lang, "lang", "left").select(
        "doc_id", "lang", "n_scored", "perplexity", limit.alias("threshold"), fits.alias("kept")
    )
