"""Best partners against all products."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from signalbook.operators import top_products as tp

TYPES = "id long, features array<double>"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v) for i, v in enumerate(vectors)], TYPES)


def by_all_products(asking, offered, n, first=0):
    width = max((len(v) for v in [*asking, *offered]), default=0)
    fill = lambda vs: np.array([list(v) + [0.0] * (width - len(v)) for v in vs]).reshape(-1, width)
    a, b = fill(asking), fill(offered)
    out = []
    for i, x in enumerate(a):
        scores = np.cumsum(b * x, axis=1)[:, -1] if width else np.zeros(len(b))
        order = np.lexsort((np.arange(len(b)), -scores))[:n]
        out += [(i, first + int(j), r, float(scores[j])) for r, j in enumerate(order, 1)]
    return out


def got(df):
    rows = [tuple(r) for r in df.select("asking", "offered", "rank", "score").collect()]
    return sorted(rows, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("block", [16, 4_096])
@pytest.mark.parametrize("kind", ["normal", "long tail", "whole numbers", "one-hot"])
def test_as_by_all_products(spark, kind, block):
    draw = np.random.default_rng(len(kind))
    a, b = draw.standard_normal((90, 7)), draw.standard_normal((400, 7))
    if kind == "long tail":
        b *= draw.pareto(1.0, 400)[:, None]
    elif kind == "whole numbers":  # very many ties
        a, b = np.round(a), np.round(b)
    elif kind == "one-hot":
        a, b = np.eye(7)[draw.integers(7, size=90)], np.eye(7)[draw.integers(7, size=400)]
    df = tp.top_products(frame(spark, a.tolist()).repartition(3), frame(spark, b.tolist(), 1_000).repartition(4), 9, block)
    assert got(df) == by_all_products(a.tolist(), b.tolist(), 9, 1_000)


def test_cells_do_not_change_the_answer(spark, monkeypatch):
    draw = np.random.default_rng(3)
    a, b = np.round(2 * draw.standard_normal((60, 4))).tolist(), np.round(2 * draw.standard_normal((200, 4))).tolist()
    expected = by_all_products(a, b, 5)
    for asking, offered in ((7, 30), (60, 1_000), (1_000, 11)):
        monkeypatch.setattr(tp, "ASKING", asking)
        monkeypatch.setattr(tp, "OFFERED", offered)
        assert got(tp.top_products(frame(spark, a), frame(spark, b), 5, 32)) == expected


def test_odd_rows(spark):
    nan = float("nan")
    a = frame(spark, [[1.0, 2.0], [0.0, 0.0], [1.0], [nan, 1.0], None, [None, 1.0]])
    a = a.unionAll(spark.createDataFrame([(None, [1.0, 1.0])], TYPES)).select("*", F.lit(1).alias("rank"), F.lit(1).alias("x"))
    b = frame(spark, [[1.0, 1.0], [3.0], [-1.0, 0.5, 7.0], [float("inf"), 0.0], []])
    rows = got(tp.top_products(a, b, 9))
    assert [r for r in rows if r[0] == 0] == [(0, 0, 1, 3.0), (0, 1, 2, 3.0), (0, 2, 3, 0.0), (0, 4, 4, 0.0)]
    assert [r[1:] for r in rows if r[0] == 1] == [(0, 1, 0.0), (1, 2, 0.0), (2, 3, 0.0), (4, 4, 0.0)]
    assert [r[1:] for r in rows if r[0] == 2] == [(1, 1, 3.0), (0, 2, 1.0), (4, 3, 0.0), (2, 4, -1.0)]
    assert len(rows) == 12
    assert got(tp.top_products(a.limit(0), b, 3)) == [] == got(tp.top_products(a, b.limit(0), 3))


def test_short_vectors_are_not_multiplied(monkeypatch):
    """In a cell whose rows come by length, the bound ends the search."""
    multiplied = []
    monkeypatch.setattr(tp.Best, "add", lambda self, rows, first, scores, real=tp.Best.add: (multiplied.append(scores.size), real(self, rows, first, scores))[1])
    draw = np.random.default_rng(0)
    points = draw.standard_normal((20_000, 8))
    points *= (1.0 / np.arange(1, 20_001))[:, None]
    ids = np.arange(20_000)

    def batch(kind, i, x):
        n = len(i)
        same = pa.array(np.zeros(n, np.int32))
        return pa.record_batch(
            [same, same, pa.array(np.full(n, kind, np.int32)), pa.array(i), pa.array(x.tolist(), pa.list_(pa.float64()))],
            names=["a", "p", "kind", "id", "x"],
        )

    queries = draw.standard_normal((50, 8))
    order = np.argsort(-np.linalg.norm(points, axis=1))
    batches = [batch(0, np.arange(50), queries)] + [batch(1, ids[order[k : k + 500]], points[order[k : k + 500]]) for k in range(0, 20_000, 500)]
    out = list(tp._cells(10, 500)(iter(batches)))
    assert sum(b.num_rows for b in out) == 500
    assert sum(multiplied) < 0.2 * 50 * 20_000
    found = {(r["asking"], r["offered"]) for b in out for r in b.to_pylist()}
    expected = {(i, int(j)) for i, q in enumerate(queries) for j in np.argsort(-(points @ q))[:10]}
    assert found == expected
