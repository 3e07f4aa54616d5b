"""Word shingles of texts as 64-bit hashes, computed on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes hashed at once; longer texts are cut at a space, never inside a word.
BLOCK = 1 << 19

_rng = np.random.default_rng(20240607)
_ODD = np.uint64(1)
_LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER[_SPACE] = 0
_BASE = _rng.integers(1, 1 << 63, dtype=np.uint64) | _ODD
_PLACES = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) | _ODD


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER = _powers(int(_BASE), BLOCK + 1)
_INVERSE = _powers(pow(int(_BASE), -1, 1 << 64), BLOCK + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _block_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a block; no word crosses a place in ``breaks``."""
    inside = ~_SPACE[data]
    first = np.empty(len(data), dtype=bool)
    first[0] = inside[0]
    first[1:] = inside[1:] & ~inside[:-1]
    cuts = breaks[(breaks > 0) & (breaks < len(data))]
    first[cuts] = inside[cuts]
    last = np.empty(len(data), dtype=bool)
    last[-1] = inside[-1]
    last[:-1] = inside[:-1] & ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    if len(data) <= BLOCK:
        power, inverse = _POWER[: len(data)], _INVERSE
    else:  # a block longer than BLOCK holds one very long word
        power, inverse = _powers(int(_BASE), len(data)), _powers(pow(int(_BASE), -1, 1 << 64), len(data) + 1)
    total = np.cumsum(_LETTER[data] * power, dtype=np.uint64)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    # The length is part of the word, as some letter's value might add nothing.
    return starts, mixed((total[ends] - before) * inverse[starts] + (ends - starts).astype(np.uint64))


def _blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of bytes, whole texts where they fit, else cut behind a space."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(end, at + BLOCK)
        if stop < end:
            whole = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if whole > at:
                stop = whole
            else:
                spaces = np.flatnonzero(_SPACE[data[at:stop]])
                if len(spaces):
                    stop = at + int(spaces[-1]) + 1
                else:  # one word longer than a block: up to its end
                    text_end = int(offsets[np.searchsorted(offsets, at, "right")])
                    later = np.flatnonzero(_SPACE[data[stop:text_end]])
                    stop = stop + int(later[0]) if len(later) else text_end
        yield at, stop
        at = stop


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the column and the row it is in; none for null."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, where, values = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, stop in _blocks(data, offsets):
        starts, values_ = _block_words(data[at:stop], offsets[(offsets > at) & (offsets < stop)] - at)
        hashes.append(values_)
        places.append(starts + at)
    rows = np.searchsorted(offsets, np.concatenate(places), "right") - 1
    return np.concatenate(hashes), rows.astype(np.int64)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, one text after the other and sorted
    within it, and the ``len(texts) + 1`` offsets of the texts.

    A shingle is a run of five words; a text of fewer words has one, all of
    it; a text without words has none.
    """
    word, row = words(texts)
    n = np.bincount(row, minlength=len(texts)) if len(word) else np.zeros(len(texts), np.int64)
    begins = np.concatenate(([0], np.cumsum(n)))
    full = max(0, len(word) - WORDS + 1)
    joined = np.zeros(full, np.uint64)
    for k in range(WORDS):
        joined += word[k : k + full] * _PLACES[k]
    joined = mixed(joined)
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i in np.flatnonzero(n):
        s, e = int(begins[i]), int(begins[i + 1])
        if e - s >= WORDS:
            own = np.unique(joined[s : e - WORDS + 1])
        else:
            short = (word[s:e] * _PLACES[: e - s]).sum(dtype=np.uint64) + np.uint64(e - s)
            own = mixed(np.array([short], dtype=np.uint64))
        out.append(own)
        sizes[i] = len(own)
    sets = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return sets, np.concatenate(([0], np.cumsum(sizes)))
