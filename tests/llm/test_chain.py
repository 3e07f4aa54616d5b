"""The toxicity chain against plain recomputation, and on documents it has not seen."""

import math
import random
import re

import numpy as np
import pytest

from signalbook.llm import toxicity

WORDS = [f"{a}{b}o" for a in "bdfgklmnprst" for b in "aeiou"]
CATEGORIES = ["quality", "toxic"]


def drawn(n, seed, first=0):
    """Documents whose toxicity hangs on words and on their quality."""
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(first, first + n):
        words = draw.choices(WORDS, k=draw.randint(8, 30))
        quality = int(sum(w.startswith(("b", "d")) for w in words) >= 3)
        rude = draw.random() < 0.4
        words += ["zounds", "blast"] * rude
        docs.append((i, " ".join(words).capitalize() + "!"))
        labels.append((i, quality, int(rude and not quality)))
    return docs, labels


@pytest.fixture(scope="module")
def chain(spark):
    docs, labels = drawn(900, 1)
    repeated = docs + [docs[0]] * 400 + [(None, "nobody"), (5000, "without a label")]
    frames = spark.createDataFrame(repeated, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return toxicity.fit(*frames, CATEGORIES), docs, labels


def words_in(text):
    return {w for w in re.findall(r"[^\W\d_]+", (text or "").lower())}


def recomputed(chain, text):
    """The chain of logistic functions, one word at a time."""
    own, out = words_in(text), []
    for intercept, weights in zip(chain.intercepts, chain.weights, strict=True):
        z = intercept + math.fsum(w for word, w in zip(chain.words, weights, strict=False) if word in own)
        z += math.fsum(w * p for w, p in zip(weights[len(chain.words) :], out, strict=True))
        out.append(1 / (1 + math.exp(-z)))
    return out


def test_predictions_as_recomputed(spark, chain):
    model, docs, _ = chain
    odd = [(1, None), (2, ""), (3, "zounds " * 50_000), (4, "Zounds, BLAST"), (4, "Zounds, BLAST"), (None, "bado dado")]
    frame = spark.createDataFrame(docs[:50] + odd, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.p_quality, r.p_toxic, r.quality, r.toxic) for r in toxicity.predict(frame, model).collect())
    expected = []
    for i, text in docs[:50] + odd:
        p = recomputed(model, text)
        expected.append((str(i), *p, *(x >= t for x, t in zip(p, model.thresholds, strict=True))))
    expected.sort()
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert a[0] == b[0] and a[1:3] == pytest.approx(b[1:3], abs=1e-9) and a[3:] == b[3:]


def test_words_are_those_that_tell_most(chain):
    model, docs, labels = chain
    present = [words_in(t) for _, t in docs]
    for k in (1, 2):
        truth = np.array([row[k] for row in labels], bool)
        scores = {}
        for word in set().union(*present):
            has = np.array([word in p for p in present])
            if has.sum() >= toxicity.LEAST_DOCS:
                apart = float((has & truth).sum()) * len(truth) - float(has.sum()) * truth.sum()
                scores[word] = apart * apart / (has.sum() * (len(truth) - has.sum()) + 1.0)
        top = sorted(scores, key=lambda w: (-scores[w], w))[: toxicity.WORDS]
        assert set(top) <= set(model.words)


def test_weights_solve_the_first_problem(chain):
    """At the optimum of the regularised loss its gradient is zero.  Rows that
    repeat a document count once."""
    model, docs, labels = chain
    x = np.array([[w in words_in(t) for w in model.words] for _, t in docs], float)
    y = np.array([row[1] for row in labels], float)
    p = 1 / (1 + np.exp(-(model.intercepts[0] + x @ model.weights[0])))
    gradient = x.T @ (p - y) / len(y) + toxicity.REGULARISATION * model.weights[0]
    assert np.abs(gradient).max() < 2e-3 and abs(float((p - y).mean())) < 2e-3


def test_documents_not_seen(spark, chain):
    docs, labels = drawn(400, 2, first=10_000)
    got = {r.doc_id: r for r in toxicity.predict(spark.createDataFrame(docs, "doc_id long, text string"), chain[0]).collect()}
    assert np.mean([got[i].quality == q for i, q, _ in labels]) > 0.93
    assert np.mean([got[i].toxic == t for i, _, t in labels]) > 0.93
    # The later link leans on the earlier one: rude words of good documents are let be.
    assert chain[0].weights[1][-1] < 0
