"""Packing of tokenised documents into fixed-length sequences.

Best-fit decreasing runs on partitions of bounded size.  For each partition
dual feasible functions give a lower bound on the number of sequences any
packing needs; where best-fit meets it, the partition is certified and left.
The documents of the others go into a pool, are dealt anew and packed again;
a round's packing counts only if it saves sequences.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.llm.store import slices, stored

END_ID = 0
#: Pieces in a partition that one task packs.
PER_PARTITION = 20_000
ROUNDS = 4
#: Largest k of the rounding functions in the bound.
_MOST_K = 60


@lru_cache(2)
def encoding(path: str) -> tiktoken.Encoding:
    """The tokenizer of a file with one base64 piece and its id per line, and
    the added tokens of the JSON file of the same name, if there is one.
    ``encode`` with all special tokens allowed gives the ids of that file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    listed = Path(path).with_suffix(".json")
    added = json.loads(listed.read_text("utf-8"))["added_tokens"] if listed.exists() else []
    special = {token["content"]: token["id"] for token in added}
    return tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


# The white space of the tokenizer's pattern.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space from this length on are encoded by themselves; the
#: pattern would go back over all of a run.
_LONG_RUN = 1 << 8
_RUNS = re.compile(f"[{_SPACE}]{{{_LONG_RUN},}}+")


def encoded(tokens: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text, added tokens included.

    The pattern makes one piece of a run of white space, less its last
    character where text follows; so a long run is cut out as that piece, and
    what is left of it begins the rest."""
    ids: list[int] = []
    at = 0
    for run in _RUNS.finditer(text):
        end = run.end()
        follows = end < len(text) and not any(text.startswith(added, end) for added in tokens.special_tokens_set)
        ids += tokens.encode(text[at : run.start()], allowed_special="all")
        at = end - follows
        ids += tokens._encode_single_piece(text[run.start() : at])
    return ids + tokens.encode(text[at:], allowed_special="all")


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens; the first takes the rest."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def _pieces(path: str, length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(encoded, encoding(path))
        for batch in slices(batches, "text"):
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
                for piece, (start, n) in enumerate(cuts(len(ids), length)):
                    crc = zlib.crc32(ids[start : start + n].tobytes())
                    for column, value in zip(out, (doc_id, piece, start, n, crc), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.record_batch(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows


def tokenised(docs: DataFrame, length: int, path: str | None = None) -> DataFrame:
    """The pieces of every document (``doc_id``, ``piece``, ``start``,
    ``length``, ``ids_crc32``, unique ``item``), stored.

    The string of an added token is that token; a null text is empty and has
    the end id alone; only a document longer than ``length`` is cut.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = docs.select("doc_id", "text").mapInArrow(
        _pieces(path, length), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )
    return stored(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each length, which must come in descending order: the fullest bin
    it fits into, else a new one."""
    bins = np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0  # bit r of ``rooms``: some bin has room r
    for i, n in enumerate(lengths.tolist()):
        fits = rooms >> n
        if fits:
            room = (fits & -fits).bit_length() - 1 + n
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, opened
            opened += 1
        bins[i] = b
        if room > n:
            by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the largest sum that a dual feasible function
    gives, rounded up.

    One family counts lengths over ``capacity - e`` as whole bins and drops
    those under ``e``; the other rounds multiples of a (k+1)-th down to k-ths.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    many, mass = np.cumsum(count), np.cumsum(count * size)
    best = -(-int(mass[-1]) // capacity)
    e = np.arange(1, capacity // 2 + 1)
    whole = many[-1] - many[capacity - e]
    middle = mass[capacity - e] - mass[e - 1]
    if len(e):
        best = max(best, int((whole - (-middle // capacity)).max()))
    for k in range(1, _MOST_K):
        exact = (k + 1) * size % capacity == 0
        kept = int((count * size)[exact].sum())
        rounded = int((count * ((k + 1) * size // capacity))[~exact].sum())
        best = max(best, -(-(kept * k + rounded * capacity) // (capacity * k)))
    return best


def _packed(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "item"], ascending=[False, True], ignore_index=True)
        lengths = rows["length"].to_numpy()
        rows["bin"] = best_fit(lengths, capacity)
        grouped = rows.groupby("bin")
        fill = grouped["length"].transform("sum")
        n_bins = int(rows["bin"].max()) + 1
        gap = n_bins - lower_bound(lengths, capacity)
        # Full sequences stay; of the others, those of a partition with a gap
        # and the emptiest one of any partition can be packed better.
        open_ = (fill < capacity) & ((gap > 0) | (rows["bin"] == rows["bin"][fill.idxmin()]))
        return pd.DataFrame(
            {
                "item": rows["item"],
                "length": rows["length"],
                "sequence_id": grouped["item"].transform("min"),
                "offset": grouped["length"].cumsum() - rows["length"],
                "loose": open_,
            }
        )

    return pack


def pack(pieces: DataFrame, capacity: int, per_partition: int | None = None) -> DataFrame:
    """``item``, ``sequence_id``, ``offset`` for rows of ``item`` (unique) and
    ``length`` (1 to ``capacity``).  A sequence is named by its smallest item.
    The same items give the same packing; no items give an empty table."""
    per_partition = per_partition or PER_PARTITION
    columns = ("item", "sequence_id", "offset")
    whole = pieces.filter(F.col("length") == capacity).select(
        "item", F.col("item").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    pool = pieces.filter(F.col("length") < capacity).select("item", "length")
    settled, best, loose = [whole], None, None
    for turn in range(ROUNDS):
        n = pool.count()
        if n == 0:
            break
        parts = -(-n // per_partition)
        dealt = pool.withColumn("part", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(parts)))
        packing = stored(
            dealt.groupBy("part").applyInPandas(
                _packed(capacity), "item long, length long, sequence_id long, offset long, loose boolean"
            ),
            "packing",
        )
        if best is not None and packing.filter("item = sequence_id").count() >= best:
            break  # nothing saved: the packing before stays
        settled.append(packing.filter("not loose").select(*columns))
        loose = packing.filter("loose")
        best, pool = loose.filter("item = sequence_id").count(), loose.select("item", "length")
    if loose is not None:
        settled.append(loose.select(*columns))
    out = settled[0]
    for part in settled[1:]:
        out = out.unionAll(part)
    return out


def packed_documents(docs: DataFrame, length: int = 2048, path: str | None = None) -> DataFrame:
    """Every piece of every document with its place: ``doc_id``, ``piece``,
    ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.  Rows
    that repeat a document are packed like other documents."""
    pieces = tokenised(docs, length, path)
    return pieces.join(pack(pieces, length), "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
