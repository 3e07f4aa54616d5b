"""The projection forest: budget, recall, ties and lengths."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbook.llm import ann

TYPES = "vec_id long, embedding array<double>"


def answers(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append(r.vec_id)
    return dict(out)


def exact(vectors, asks, k):
    """By all products, in order of score and id."""
    ids = np.arange(len(vectors))
    out = {}
    for i in asks:
        scores = np.cumsum(vectors * vectors[i], axis=1)[:, -1]
        order = np.lexsort((ids, -scores))
        out[i] = [int(j) for j in order[order != i][:k]]
    return out


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_with_leaves_left_out(spark, clusters):
    draw = np.random.default_rng(clusters)
    x = draw.standard_normal((8_000, 24))
    if clusters:
        x = 0.3 * x + draw.standard_normal((clusters, 24))[draw.integers(clusters, size=len(x))]
    df = spark.createDataFrame(list(enumerate(x.tolist())), TYPES)
    got = answers(ann.nearest(df, F.col("vec_id") % 20 == 0))
    true = exact(x, range(0, len(x), 20), 20)
    assert got.keys() == true.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[i]) & set(true[i])) / 20 for i in true]) >= 0.9
    # What the budget leaves out.
    longest = float(np.linalg.norm(x, axis=1).max())
    lifted = ann._lifted(x, longest)
    forest = [ann.grown(lifted, ann.LEAF, t) for t in range(ann.TREES)]
    at = np.stack([ann.leaves(t, lifted) for t in forest])
    sizes = [np.bincount(a, minlength=t.n_leaves) for a, t in zip(at, forest, strict=True)]
    asks = list(true)[:40]
    enough = ann.budget(forest, sizes, x[asks], [x[true[i]] for i in asks], longest)
    seen = []
    for i in asks:
        met, held = np.zeros(len(x), bool), 0
        for t, leaf, size in ann.visited(forest, sizes, np.r_[x[i], 0.0]):
            met |= at[t] == leaf
            held += size
            if held >= enough:
                break
        seen.append(met.mean())
    assert np.mean(seen) < (0.2 if clusters else 0.6)


def test_a_budget_by_hand_is_kept(spark):
    x = np.random.default_rng(1).standard_normal((3_000, 16))
    df = spark.createDataFrame(list(enumerate(x.tolist())), TYPES)
    true = exact(x, range(0, 3_000, 100), 10)
    shares = []
    for searched in (300, 3_000, 30_000):
        got = answers(ann.nearest(df, F.col("vec_id") % 100 == 0, k=10, searched=searched))
        shares.append(np.mean([len(set(got[i]) & set(true[i])) / 10 for i in true]))
    assert shares[0] < shares[1] < shares[2] == 1.0


def test_ties_go_to_the_smaller_id(spark):
    """Very many vectors with the same product, in any layout."""
    draw = np.random.default_rng(2)
    x = np.zeros((400, 12))
    x[np.arange(400), 1 + draw.integers(11, size=400)] = 1.0  # one-hot beside a common first component
    x[:, 0] = 1.0
    x += 0.0
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    rows += [(1000 + i, [1.0] + [0.0] * 10 + [0.5 + i / 1000]) for i in range(60)] + [(2000, [1.0] + [0.0] * 11)]
    everything = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    for seed in (1, 2):
        df = spark.createDataFrame(rows, TYPES).repartition(3 + seed).orderBy(F.rand(seed))
        got = answers(ann.nearest(df, F.col("vec_id") % 20 == 0))
        for i in got:
            scores = np.cumsum(everything * everything[ids == i][0], axis=1)[:, -1]
            order = np.lexsort((ids, -scores))
            assert got[i] == [int(j) for j in ids[order] if j != i][:20], i


def test_each_length_by_itself(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.standard_normal(5 if i % 3 else 4).tolist()) for i in range(120)]
    got = answers(ann.nearest(spark.createDataFrame(rows, TYPES), F.col("vec_id") % 20 == 0, k=8))
    for i, v in rows[::20]:
        own = [(-float(np.cumsum(np.multiply(v, w))[-1]), j) for j, w in rows if len(w) == len(v) and j != i]
        assert got[i] == [j for _, j in sorted(own)[:8]]


def test_planes_are_bounded(spark, monkeypatch):
    """A forest of long vectors gets larger leaves, not more planes."""
    monkeypatch.setattr(ann, "PLANES", 200_000)
    x = np.random.default_rng(4).standard_normal((1_000, 200))
    df = spark.createDataFrame([(v.tolist(), i) for i, v in enumerate(x)], "vector array<double>, v long")
    forest = ann.fitted(df, len(x), float(np.linalg.norm(x, axis=1).max()))
    assert 0 < sum(t.planes.nbytes for t in forest) <= 200_000
