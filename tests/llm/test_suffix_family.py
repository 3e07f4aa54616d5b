"""Passages that stand twice, against a count of every window."""

import hashlib
import random
from collections import Counter
from itertools import count

import pytest
from pyspark.sql import functions as F

from signalbook.llm import suffix_family as sf

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def counted(rows, length):
    """The same by counting all windows of all rows."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    times = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts(length):
    """Shared passages in various surroundings, copies, runs, nulls, ties."""
    draw = random.Random(length)
    words = [f"w{i}" for i in range(300)]
    passages = [" ".join(draw.choices(words, k=max(8, 40 * length // 100))) for _ in range(6)]
    rows = []
    for d in range(50):
        parts = []
        for _ in range(draw.randint(0, 5)):
            shared = draw.random() < 0.5
            parts.append(draw.choice(passages)[draw.randint(0, 9) :] if shared else " ".join(draw.choices(words, k=length // 5)))
        rows.append((d, "é ".join(parts)))
    rows += [(1, rows[1][1]), (1, rows[1][1]), (100, "a" * (3 * length)), (101, "ab" * length), (102, None), (103, "")]
    rows += [(None, "x" * (length + 1)), (None, "nothing"), (104, passages[0][:length]), (105, passages[0][1 : length + 1])]
    return [*rows, (106, "y" * (length - 1)), (107, "zq" + "k" * length)]


@pytest.mark.parametrize("length, gram, grid, batches", [(400, 32, 128, 4), (40, 4, 16, 3), (20, 3, 10, 1), (40, 8, 30, 7)])
def test_same_bytes_go_as_by_counting(spark, length, gram, grid, batches):
    rows = texts(length)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.select("*", *[F.lit("old").alias(c) for c in ("suffix", "first", "found", "k1", "spans", "part")])
    got = sf.repeated_passages(docs, length, gram, grid, batches)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == counted(rows, length)


def test_long_texts_and_their_spans(spark):
    """Texts longer than what a task looks at together, with a passage over the seam."""
    draw = random.Random(5)
    letters = "".join(draw.choices("abcdefgh ", k=2_600_000))
    seam = sf._CHUNK - 1_500
    rows = [(1, letters), (2, letters[seam : seam + 3_500] + "!" + letters[100:499]), (3, "k" * 20_000), (4, letters[:399])]
    got = sf.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    got = {r.doc_id: r for r in got.collect()}
    assert [tuple(s) for s in got[1].spans] == [(seam, seam + 3_500)]
    assert [tuple(s) for s in got[2].spans] == [(0, 3_500)]
    kept = letters[:seam] + letters[seam + 3_500 :]
    assert got[1].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert got[3].n_removed == 20_000 and got[4].n_removed == 0


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sf.repeated_passages(none).count() == 0


def test_arrays_and_shuffles_are_given_up_once_judged(spark, tmp_path, monkeypatch):
    """On disk stay the judged texts and the windows; the setting is left as it was."""
    from signalbook.llm import store

    number = count()
    monkeypatch.setattr(sf, "new_dir", lambda _spark, name: f"{tmp_path}/{name}-{next(number)}")
    freed = []
    monkeypatch.setattr(sf, "stored", lambda df, name: freed.append(spark.conf.get(store._CLEANUP)) or store.stored(df, name))
    before = spark.conf.get(store._CLEANUP, "false")
    rows = texts(40)
    got = sf.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 40, 4, 16, 3)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == counted(rows, 40)
    assert freed == ["true"] and spark.conf.get(store._CLEANUP) == before
    assert len(list(tmp_path.glob("suffixes-*"))) == 1 and not list(tmp_path.glob("entries-*"))


def test_a_passage_in_a_third_of_all_rows_is_spread(spark):
    """No task scans more than its share of a suffix array."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    draw = random.Random(2)
    shared = "".join(draw.choices("abcdefgh ", k=1200))
    rows = [(i, "".join(draw.choices("mnopqrst ", k=900)) + (shared if i % 3 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.select("text", F.col("doc_id").alias("k1"), F.xxhash64("text").alias("k2"))
    array, _, _ = sf.scanned(keyed.mapInArrow(sf._entries(400, 32, 128), sf.ENTRY))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    shares = [r["count"] for r in array.groupBy("part").count().collect()]
    assert len(shares) > 4 and max(shares) < 2.5 * sum(shares) / len(shares)
    got = sf.repeated_passages(docs).collect()
    # Letters before the passage that agree by chance with those of another row go too.
    ends = Counter(t[-1200 - k : -1200] for i, t in rows if i % 3 == 0 for k in range(1, 20))
    more = {i: sum(ends[t[-1200 - k : -1200]] > 1 for k in range(1, 20)) for i, t in rows}
    assert {r.doc_id: r.n_removed for r in got} == {i: 1200 + more[i] if i % 3 == 0 else 0 for i, _ in rows}
