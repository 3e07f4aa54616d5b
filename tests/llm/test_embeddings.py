"""Whitening against a dense solver, hard negatives against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalbook.llm import hard_negatives as hn
from signalbook.llm import whitening as wh

TYPES = "vec_id long, label int, embedding array<float>"


def drawn(n, width, seed, labels=4):
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((n, width)) * np.linspace(1.5, 0.5, width)
    return [(i, int(draw.integers(labels)), [float(np.float32(c)) for c in row]) for i, row in enumerate(x)]


def odd(rows):
    """With copies, nulls, numbers that are not finite, short vectors, ties."""
    nan, inf = float("nan"), float("inf")
    more = [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)] + [rows[7], rows[7]]
    more += [(2000, 1, None), (2001, 1, [nan] * 3), (2002, 1, [inf, 0.0]), (2003, 1, [None, 1.0]), (2004, None, rows[1][2])]
    more += [(2005, 2, [1.0]), (2006, 2, []), (None, 1, rows[3][2]), (2007, 3, [0.0] * 6), (2008, 1, [1e30, 0.0])]
    return rows + more


def ints(vector, width):
    return [max(-(1 << 63), min((1 << 63) - 1, int(np.floor(256.0 * c)))) for c in vector] + [0] * (width - len(vector))


def taking_part(rows):
    return [r for r in rows if r[2] is not None and all(c is not None and np.isfinite(c) for c in r[2])]


# --- hard negatives ------------------------------------------------------------


def by_all_products(rows, is_anchor, n_pos, n_neg, span):
    rows = [r for r in taking_part(rows) if r[0] is not None and r[1] is not None]
    width = max(len(r[2]) for r in rows)
    rows = sorted({(i, label, tuple(ints(v, width))) for i, label, v in rows})
    cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for a in filter(lambda r: is_anchor(r[0]), rows):
        scored = sorted(((-sum(p * q for p, q in zip(a[2], r[2], strict=True)), r[0], r) for r in rows if r != a))
        for s, i, _ in [t for t in scored if t[2][1] == a[1]][:n_pos]:
            pos = cut(-s)
            fit = [t for t in scored if t[2][1] != a[1] and span[0] * pos <= -t[0] * span[2] <= span[1] * pos]
            out += [(a[0], i, k, t[1], pos, cut(-t[0])) for k, t in enumerate(fit[:n_neg], 1)]
    return sorted(out)


@pytest.mark.parametrize("n, width, block, step", [(300, 6, 64, 10), (500, 20, 50, 7), (40, 1, 8_192, 3), (200, 2, 16, 5)])
def test_negatives_as_by_all_products(spark, n, width, block, step):
    rows = odd(drawn(n, width, seed=width))
    df = spark.createDataFrame(rows, TYPES).repartition(3).select("*", *[F.lit("old").alias(c) for c in ("g", "x", "rank", "id", "bound")])
    got = hn.hard_negatives(df, F.col("vec_id") % step == 0, positives=3, negatives=4, block=block)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = by_all_products(rows, lambda i: i % step == 0, 3, 4, (30, 90, 100))
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == expected
    assert len(expected) > 20 or width == 1


def test_lists_end_the_search_early():
    """Rows along one direction: the threshold falls below the first scores soon."""
    draw = np.random.default_rng(0)
    x = (np.outer(np.linspace(1000, 1, 4000), np.ones(4)) + draw.integers(0, 3, (4000, 4))).astype(np.int64)
    block = hn.Lists(x, np.arange(4000), np.arange(4000) % 2, np.float64)
    best = hn.Best(5, None, None, x[0])
    scored = block.search(x[0].astype(float), block.labels == 0, [best])
    products = x @ x[0]
    even = sorted((-int(products[i]), i) for i in range(0, 4000, 2))[:5]
    assert [(s, i) for s, i, _ in best.rows] == even
    assert scored < 200


def test_no_anchors_and_no_rows(spark):
    df = spark.createDataFrame(drawn(20, 3, 1), TYPES)
    assert hn.hard_negatives(df, F.lit(False)).count() == 0
    assert hn.hard_negatives(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0


# --- whitening -----------------------------------------------------------------


@pytest.mark.parametrize("n, width, k", [(400, 8, 4), (50, 3, 4), (2_000, 64, 4)])
def test_whitening_as_by_a_dense_solver(spark, n, width, k):
    rows = drawn(n, width, seed=n)
    rows = rows + [(10_000 + i, 0, rows[5][2]) for i in range(300)] + [(2000, 1, None), (2001, 1, [float("nan")] * width)]
    rows += [(None, None, rows[9][2]), (2002, 1, rows[1][2][:-1])]
    df = spark.createDataFrame(rows, TYPES).repartition(5).select("*", *[F.lit("old").alias(c) for c in ("x", "n", "i", "component")])
    got = wh.whitened(df, k).collect()
    kept = taking_part(rows)
    assert len(got) == len(kept) * min(k, width)
    x = {i: np.array(ints(v, width)) for i, _, v in kept}
    fit = np.unique(np.array([ints(v, width) for _, _, v in kept]), axis=0)
    size, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    for r in got:
        e, v = values[-r.component], axes[:, -r.component]
        assert r.n == size and r.deviation == int(((size * x[r.vec_id] - sums) ** 2).sum())
        assert r.explained == pytest.approx(e / values.sum(), rel=1e-10)
        assert abs(r.whitened) == pytest.approx(abs((x[r.vec_id] - sums / size) @ v / np.sqrt(e)), abs=1e-8)
        assert r.identity_error < 1e-9
    signs = {}
    for r in got:
        other = float((x[r.vec_id] - sums / size) @ axes[:, -r.component])
        if abs(other) > 1e-6:
            signs.setdefault(r.component, set()).add(r.whitened * other > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_nothing_to_whiten(spark):
    df = spark.createDataFrame([(1, 1, [1.0, 2.0]), (2, 1, [1.0, 2.0])], TYPES)
    assert wh.whitened(df).count() == 0 and wh.whitened(df.limit(0)).count() == 0
    line = spark.createDataFrame([(i, 1, [float(i), 2.0 * i, 0.0]) for i in range(9)], TYPES)
    assert {r.component for r in wh.whitened(line).collect()} == {1}  # two zero eigenvalues


def test_numbers_of_any_size(spark):
    rows = [(i, 1, [float(i) * 1e15, 1.0, -float(i)]) for i in range(6)]
    got = wh.whitened(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), 1).collect()
    assert all(r.deviation is None for r in got) and got[0].identity_error < 1e-9
    assert got[0].explained == pytest.approx(1.0)


@pytest.mark.parametrize(
    "m, values",
    [
        (np.diag([3.0, 3, 2, 2, 1, 0]), [3, 3, 2, 2]),  # equal ones
        (np.diag([5.0, 0, 0]), [5]),
        (np.zeros((3, 3)), []),
        (np.diag([1 + 1e-13, 1, 1 - 1e-13, 0.5]), [1, 1, 1, 0.5]),  # a cluster
        (np.array([[2.0, 1, 0, 0], [1, 2, 0, 0], [0, 0, 2, 1], [0, 0, 1, 2]]), [3, 3, 1, 1]),
    ],
)
def test_slices_of_a_spectrum(m, values):
    found = wh.leading(m, 4)
    assert [e for e, _ in found] == pytest.approx(values)
    vectors = np.array([v for _, v in found]).reshape(len(found), len(m))
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max(initial=0) < 1e-12
    assert all(np.linalg.norm(m @ v - e * v) < 1e-13 for e, v in found)


def test_inertia_counts_the_eigenvalues():
    draw = np.random.default_rng(3)
    for n in (1, 2, 7, 30):
        m = draw.standard_normal((n, n))
        m = m + m.T  # indefinite, so pivots of two rows occur
        values = np.linalg.eigvalsh(m)
        for shift in (values[:-1] + values[1:]) / 2:
            assert wh.above(m, shift) == (values > shift).sum()
