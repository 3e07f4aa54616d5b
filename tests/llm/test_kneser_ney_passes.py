"""The Kneser-Ney model counted in passes and buckets, against one count of all n-grams."""

import math
import random

import numpy as np
import pyarrow as pa
from test_llm_operators import brute_perplexity

from signalbook.llm import kn_quality


def test_passes_buckets_and_split_characters_give_the_same(spark, monkeypatch):
    """A pass sends a share of the windows only; 'e' is in every other place, so its counts meet in several buckets."""
    monkeypatch.setattr(kn_quality, "LEAST_PASS", 60)
    monkeypatch.setattr(kn_quality, "PASSES", 3)
    monkeypatch.setattr(kn_quality, "BUCKET", 100)
    monkeypatch.setattr(kn_quality, "LEAST_BUCKET", 100)
    plans = []
    plan = kn_quality.Plan
    monkeypatch.setattr(kn_quality, "Plan", lambda counts: plans.append((plan(counts), counts)) or plans[-1][0])
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcdfgh ") + "e" for _ in range(draw.randint(5, 25))) for _ in range(40)]
    rows = [*enumerate(texts), (0, texts[0]), (50, None), (51, ""), (None, texts[1])]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    got = kn_quality.perplexities(docs, labels).collect()
    used, counts = plans[0]
    assert used.n_passes == 3 and used.buckets > 2 and used.splits[ord("e")] > 1
    shares = np.bincount(used.passes, counts, minlength=3)
    assert counts.sum() == sum(len(t) for _, t in rows if t) and shares.max() < 0.7 * counts.sum()
    text = dict(rows)
    trusted = [text[r.doc_id] for r in got if r.held is False]
    assert len(got) == len(rows) and trusted.count(texts[0]) in (0, 2)
    for r in got:
        if not text[r.doc_id]:
            assert r.n_scored == 0
            continue
        assert math.isclose(r.perplexity, brute_perplexity(trusted, text[r.doc_id]), rel_tol=1e-9)


def test_windows_of_a_share_of_the_characters():
    """Each window is found once, whatever the shares, and none that ends in a pad."""
    sizes, codes = kn_quality._characters(pa.array(["abcab", None, "b", "", "cc"]))
    assert sizes.tolist() == [5, 0, 1, 0, 2]
    marks = np.zeros(1 << 16, bool)
    marks[[ord("a"), ord("c")]] = True
    some, rest = kn_quality._windows(codes, marks), kn_quality._windows(codes, ~marks)
    assert len(some) + len(rest) == 8 and not set(some) & set(rest)
    whole = kn_quality.Grams(pa.array(["abcab", None, "b", "", "cc"]))
    found = sorted("".join(map(chr, codes[i : i + 4])) for i in [*some, *rest])
    keys, n = whole.counted()
    assert found == sorted(g for g, times in zip(whole.spelled(keys), n.tolist(), strict=True) for _ in range(times))
