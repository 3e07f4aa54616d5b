"""Language identification with unigrams over the pieces of a public vocabulary.

A language is a probability for each piece.  A word's probability under it is
the sum over all ways to cut the word into pieces, which the forward algorithm
gives in one pass; a text's is the product over its words.  The probabilities
are learned by expectation maximisation with the same sums.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.llm.store import slices, stored

#: Documents per language that the fit takes, on average over draws by hash.
FIT_DOCS = 4000
ITERATIONS = 3
SMOOTHING = 0.01
UNDETERMINED = "und"
_BREAKS = r"[^\p{L}\p{M}]+"
#: Words up to this many bytes go through the arrays, longer ones one by one.
_LONG = 40
#: Every byte's share in a probability is scaled by this, to stay in range.
_SCALE = 64.0
#: Bytes of text that share their distinct words' scores.
_SLICE = 1 << 23
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary as a hash table from the bytes of a piece to its number."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.pieces = [base64.b64decode(line.split()[0]) for line in lines]
        self.number = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces))
        codes = np.array([self._code(p) for p in self.pieces], dtype=np.uint64)
        self.bits = 20
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        for i, code in enumerate(codes.tolist()):
            slot = code >> (64 - self.bits)
            while self.values[slot] >= 0:
                slot = (slot + 1) % len(self.values)
            self.keys[slot], self.values[slot] = code, i
        self.probes = 1
        while not (self.find(codes) == np.arange(len(codes))).all():
            self.probes += 1

    @staticmethod
    def _code(piece: bytes) -> int:
        code = 0
        for byte in piece:
            code = (code + byte + 1) * int(_MULTIPLIER) % (1 << 64)
        return code

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 for none."""
        slot = (codes >> np.uint64(64 - self.bits)).astype(np.int64)
        found = np.full(len(codes), -1, np.int32)
        for step in range(self.probes):
            at = (slot + step) & ((1 << self.bits) - 1)
            found = np.where((self.keys[at] == codes) & (self.values[at] >= 0), self.values[at], found)
        return found


@lru_cache(1)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def spans(pieces: Pieces, words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Begin, end, rows and piece numbers of the pieces in words of one length
    (one word's bytes per row)."""
    n, length = words.shape
    plain = words.astype(np.uint64) + np.uint64(1)
    code = np.zeros((n, length), np.uint64)  # of the piece that begins here
    for size in range(1, min(length, pieces.longest) + 1):
        starts = length - size + 1
        code = (code[:, :starts] + plain[:, size - 1 :]) * _MULTIPLIER
        number = pieces.find(code.ravel()).reshape(n, starts)
        for begin in range(starts):
            rows = np.flatnonzero(number[:, begin] >= 0)
            if len(rows):
                yield begin, begin + size, rows, number[rows, begin]


def forward(pieces: Pieces, words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Scaled probability of each word in each language: ``table`` has a row
    per piece and a column per language."""
    n, length = words.shape
    total = np.zeros((length + 1, n, table.shape[1]))
    total[0] = 1.0
    for begin, end, rows, number in sorted(spans(pieces, words), key=lambda s: s[1]):
        total[end][rows] += total[begin][rows] * table[number]
    return total[length]


def expected(pieces: Pieces, words: np.ndarray, weights: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Expected number of each piece over all segmentations of the words, each
    counted ``weights`` times; ``table`` is one language's."""
    n, length = words.shape
    found = sorted(spans(pieces, words), key=lambda s: s[1])
    ahead, behind = np.zeros((length + 1, n)), np.zeros((length + 1, n))
    ahead[0] = behind[length] = 1.0
    for begin, end, rows, number in found:
        ahead[end][rows] += ahead[begin][rows] * table[number]
    for begin, end, rows, number in sorted(found, key=lambda s: -s[0]):
        behind[begin][rows] += behind[end][rows] * table[number]
    share = weights / ahead[length]
    out = np.zeros(len(table))
    for begin, end, rows, number in found:
        out += np.bincount(
            number, ahead[begin][rows] * table[number] * behind[end][rows] * share[rows], minlength=len(table)
        )
    return out


def long_word(pieces: Pieces, word: bytes, logs: np.ndarray) -> np.ndarray:
    """Log probability of one word of any length in each language."""
    total = np.full((len(word) + 1, logs.shape[1]), -np.inf)
    total[0] = 0.0
    for end in range(1, len(word) + 1):
        for begin in range(max(0, end - pieces.longest), end):
            number = pieces.number.get(word[begin:end])
            if number is not None:
                total[end] = np.logaddexp(total[end], total[begin] + logs[number])
    return total[-1]


def long_expected(pieces: Pieces, word: bytes, logs: np.ndarray) -> tuple[list[int], list[float]]:
    """Numbers of pieces and how often each is expected over all segmentations
    of one word of any length; ``logs`` is one language's."""
    found = []
    for end in range(1, len(word) + 1):
        for begin in range(max(0, end - pieces.longest), end):
            number = pieces.number.get(word[begin:end])
            if number is not None:
                found.append((begin, end, number))
    ahead, behind = np.full(len(word) + 1, -np.inf), np.full(len(word) + 1, -np.inf)
    ahead[0] = behind[-1] = 0.0
    for begin, end, number in found:
        ahead[end] = np.logaddexp(ahead[end], ahead[begin] + logs[number])
    for begin, end, number in sorted(found, key=lambda s: -s[0]):
        behind[begin] = np.logaddexp(behind[begin], behind[end] + logs[number])
    shares = [float(np.exp(ahead[b] + logs[k] + behind[e] - ahead[-1])) for b, e, k in found]
    return [k for _, _, k in found], shares


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and byte rows of the words, those of one length together."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths[lengths <= _LONG]):
        at = np.flatnonzero(lengths == length)
        for i in range(0, len(at), 5_000):
            part = at[i : i + 5_000]
            rows = np.frombuffer(b"".join(words[j] for j in part), np.uint8).reshape(-1, length)
            yield part, rows


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The lower-cased runs of letters and marks of a column, and the row each
    is in; a run without a letter is no word."""
    runs = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), _BREAKS)
    words, rows = pc.list_flatten(runs), pc.list_parent_indices(runs)
    full = pc.match_substring_regex(words, r"\p{L}")
    return words.filter(full).dictionary_encode(), rows.filter(full).to_numpy()


def _spelled(dictionary: pa.Array) -> list[bytes]:
    """Words as the pieces have them, with the blank before a word."""
    return [b" " + w for w in dictionary.cast(pa.large_binary()).to_pylist()]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", _SLICE):
        words, rows = words_of(batch.column("text"))
        lang = batch.column("lang").dictionary_encode()
        n_words = len(words.dictionary)
        key = lang.indices.to_numpy()[rows].astype(np.int64) * n_words + words.indices.to_numpy()
        keys, n = np.unique(key, return_counts=True)
        yield pa.record_batch(
            [
                lang.dictionary.take(pa.array(keys // max(n_words, 1))),
                words.dictionary.cast(pa.string()).take(pa.array(keys % max(n_words, 1))),
                pa.array(n),
            ],
            names=["lang", "word", "n"],
        )


def _expectations(path: str, langs: list[str], table: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        scaled, logs = _scaled(pieces, table), None
        sums = np.zeros_like(table)
        for batch in batches:
            which = np.array([langs.index(x) for x in batch.column("lang").to_pylist()])
            n = batch.column("n").to_numpy().astype(float)
            words = _spelled(batch.column("word"))
            for at, letters in by_length(words):
                for k in np.unique(which[at]):
                    own = which[at] == k
                    sums[:, k] += expected(pieces, letters[own], n[at][own], scaled[:, k])
            for i, word in enumerate(words):
                if len(word) > _LONG:
                    logs = np.log(table) if logs is None else logs
                    number, share = long_expected(pieces, word, logs[:, which[i]])
                    np.add.at(sums[:, which[i]], number, np.multiply(share, n[i]))
        number, lang = np.nonzero(sums)
        yield pa.record_batch(
            [pa.array(lang.astype(np.int32)), pa.array(number.astype(np.int32)), pa.array(sums[number, lang])],
            names=["lang", "piece", "n"],
        )

    return rows


def _scaled(pieces: Pieces, table: np.ndarray) -> np.ndarray:
    sizes = np.array([len(p) for p in pieces.pieces])
    return table * (_SCALE ** np.minimum(sizes, _LONG))[:, None]


def fit(docs: DataFrame, path: str | None = None, fit_docs: int | None = None) -> tuple[list[str], np.ndarray]:
    """The languages (values of ``lang``, nulls left out) and a table with a row
    per piece and a column per language.

    About ``fit_docs`` documents of each language are drawn by a hash of their
    id.  What comes to the driver is the table, pieces times languages.
    """
    path, fit_docs = path or default_vocabulary(), fit_docs or FIT_DOCS
    labelled = docs.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = labelled.join(F.broadcast(sizes), "lang").filter(draw * F.col("n_docs") < fit_docs)
    counts = drawn.select("lang", "text").mapInArrow(_counted, "lang string, word string, n long")
    counts = stored(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs = sorted(r.lang for r in sizes.select("lang").collect())
    table = np.full((len(vocabulary(path).pieces), len(langs)), 1.0 / len(vocabulary(path).pieces))
    for _ in range(ITERATIONS if langs else 0):
        sums = counts.mapInArrow(_expectations(path, langs, table), "lang int, piece int, n double")
        sums = sums.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        found = np.zeros_like(table)
        found[sums["piece"], sums["lang"]] = sums["n"]
        table = found + SMOOTHING
        table /= table.sum(axis=0)
    return langs, table


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def scores(texts: pa.Array, pieces: Pieces, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each text in each language, and its number of words."""
    words, rows = words_of(texts)
    spelled = _spelled(words.dictionary)
    logs = np.zeros((len(spelled), table.shape[1]))
    scaled, plain = _scaled(pieces, table), None
    for at, letters in by_length(spelled):
        logs[at] = np.log(forward(pieces, letters, scaled)) - letters.shape[1] * np.log(_SCALE)
    for i, word in enumerate(spelled):
        if len(word) > _LONG:
            plain = np.log(table) if plain is None else plain
            logs[i] = long_word(pieces, word, plain)
    n = np.bincount(rows, minlength=len(texts))
    place = words.indices.to_numpy()
    sums = [np.bincount(rows, logs[place, k], minlength=len(texts)) for k in range(table.shape[1])]
    return np.stack(sums, axis=1) if sums else np.zeros((len(texts), 0)), n


def _predictions(path: str, langs: list[str], table: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        for batch in slices(batches, "text", _SLICE):
            logs, n = scores(batch.column("text"), pieces, table)
            if langs:
                odds = np.exp(logs - logs.max(axis=1, keepdims=True))
                odds /= odds.sum(axis=1, keepdims=True)
                best, sure = odds.argmax(axis=1), odds.max(axis=1)
            else:
                best, sure, n = np.zeros(len(n), int), np.zeros(len(n)), np.zeros(len(n), int)
            names = [langs[b] if k else UNDETERMINED for b, k in zip(best, n, strict=True)]
            kept = [c for c in batch.schema.names if c not in ("lang_pred", "score")]
            arrays = [batch.column(c) for c in kept]
            yield pa.record_batch(
                [*arrays, pa.array(names, pa.string()), pa.array(np.where(n > 0, sure, 0.0))],
                names=[*kept, "lang_pred", "score"],
            )

    return rows


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, path: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that
    language among the learned ones, all equally likely beforehand.  A text
    that is null or has no letter, or any text if no language was learned, is
    ``und`` with score 0.  Columns of these two names are replaced."""
    docs = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(
        _predictions(path or default_vocabulary(), langs, table), f"{fields}, lang_pred string, score double"
    )
