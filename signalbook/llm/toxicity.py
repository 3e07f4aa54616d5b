"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other; each model sees the words of
the text and the probabilities of the categories before.  While fitting, these
come from models that did not see the document, so a later model learns how
far to trust them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalbook.llm.lang_id import words_of
from signalbook.llm.store import slices, stored

#: Labelled documents that the fit takes, on average over draws by hash.
FIT_DOCS = 20_000
#: Words per category, those that tell most about it; each in at least ``LEAST_DOCS``.
WORDS = 1000
LEAST_DOCS = 5
FOLDS = 3
REGULARISATION = 1e-4
#: The drawn rows are few; more parts only make more tasks of every step of a fit.
_PARTS = 4
#: Thresholds tried for each category.
_STEPS = 50


@dataclass
class Chain:
    """Per category an intercept, a weight per word and one per earlier
    category, and the probability from which a document belongs to it."""

    categories: list[str]
    words: list[str]
    intercepts: list[float]
    weights: list[np.ndarray]
    thresholds: list[float]

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """A row per text, a column per category."""
        own, rows = words_of(texts)
        place = pc.index_in(own.dictionary.cast(pa.string()), value_set=pa.array(self.words, pa.string()))
        place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False)[own.indices.to_numpy()]
        known = place >= 0
        n_words = max(1, len(self.words))
        pairs = np.unique(rows[known].astype(np.int64) * n_words + place[known])
        rows, place = pairs // n_words, pairs % n_words
        out = np.zeros((len(texts), len(self.categories)))
        for k, (intercept, weights) in enumerate(zip(self.intercepts, self.weights, strict=True)):
            z = intercept + np.bincount(rows, weights[place], minlength=len(texts))
            z += out[:, :k] @ weights[len(self.words) :]
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        return out


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words, rows = words_of(batch.column("text"))
        n = max(1, len(words.dictionary))
        pairs = np.unique(rows.astype(np.int64) * n + words.indices.to_numpy())
        ends = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * n).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), words.dictionary.cast(pa.string()).take(pa.array(pairs % n)))
        names = [c for c in batch.schema.names if c != "text"]
        yield pa.record_batch([*[batch.column(c) for c in names], lists], names=[*names, "words"])


def _telling(sample: DataFrame, category: str, words: int) -> list[str]:
    """The words whose documents differ most from the rest in ``category``, by
    the chi-square of presence and category."""
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum(category).alias("k")).first()
    if not total.n or not total.k or total.k == total.n:
        return []
    per_word = sample.select(category, F.explode("words").alias("word")).groupBy("word")
    per_word = per_word.agg(F.count(F.lit(1)).alias("a"), F.sum(category).alias("b")).filter(F.col("a") >= LEAST_DOCS)
    a, b, n, k = F.col("a"), F.col("b"), float(total.n), float(total.k)
    apart = b * n - a * k
    chi = apart * apart / (a * (n - a) + 1.0)
    top = per_word.orderBy(chi.desc(), "word").limit(words)
    return [r.word for r in top.select("word").collect()]


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], fit_docs: int | None = None) -> Chain:
    """A chain over ``categories``, columns of ``labels`` with 0 and 1.

    About ``fit_docs`` documents with all labels are drawn by a hash of their
    id; of several labels of one document the largest counts, of several texts
    of one id the smallest, and null ids or labels are left out.  A category with
    one value in the draw gets that value's share as its probability.
    """
    fit_docs = fit_docs or FIT_DOCS
    given = labels.groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in categories])
    given = given.dropna(subset=["doc_id", *categories])
    n = given.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    given = given.filter(draw * n < fit_docs).withColumnRenamed("doc_id", "labelled")
    # Bounded by ``fit_docs``; so are the documents, one per id.
    drawn = docs.select("doc_id", "text").join(F.broadcast(given), F.col("doc_id") == F.col("labelled"))
    drawn = drawn.groupBy("doc_id", *categories).agg(F.min("text").alias("text"))
    fields = ", ".join(f"{c} int" for c in categories)
    sample = drawn.select("doc_id", *categories, "text").mapInArrow(
        _distinct_words, f"doc_id long, {fields}, words array<string>"
    )
    sample = stored(sample.repartition(_PARTS, "doc_id"), "labelled")
    words = sorted({w for c in categories for w in _telling(sample, c, WORDS)})
    chain = Chain(categories, words, [], [], [])
    vectors = CountVectorizerModel.from_vocabulary if words else None
    rows = sample.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)))
    if words:
        rows = vectors(words, inputCol="words", outputCol="present").setBinary(True).transform(rows).drop("words")
    rows = stored(rows, "features")
    for k, category in enumerate(categories):
        share = rows.agg(F.avg(category)).first()[0]
        if share is None or share in (0.0, 1.0) or not words:
            p = min(max(share or 0.0, 1e-6), 1 - 1e-6)
            chain.intercepts.append(float(np.log(p / (1 - p))))
            chain.weights.append(np.zeros(len(words) + k))
            chain.thresholds.append(0.5)
            rows = rows.withColumn(f"p_{category}", F.lit(p))
            continue
        earlier = [f"p_{c}" for c in categories[:k]]
        ready = VectorAssembler(inputCols=["present", *earlier], outputCol="inputs").transform(rows)
        linear = LogisticRegression(
            featuresCol="inputs", labelCol=category, regParam=REGULARISATION, maxIter=30, standardization=False,
            probabilityCol="likely", predictionCol="guess", rawPredictionCol="raw",
        )
        model = linear.fit(ready)
        chain.intercepts.append(float(model.intercept))
        chain.weights.append(np.array(model.coefficients.toArray()))
        parts = None
        for fold in range(FOLDS):
            others = linear.fit(ready.filter(F.col("fold") != fold))
            part = others.transform(ready.filter(F.col("fold") == fold))
            part = part.withColumn(f"p_{category}", vector_to_array("likely")[1]).drop("inputs", "likely", "guess", "raw")
            parts = part if parts is None else parts.unionByName(part)
        rows = stored(parts.coalesce(_PARTS), "features")
        chain.thresholds.append(_best_threshold(rows, category))
    return chain


def _best_threshold(rows: DataFrame, category: str) -> float:
    """The middle of the thresholds with the best F1 on the out-of-fold probabilities."""
    steps = [i / _STEPS for i in range(1, _STEPS)]
    hit, truth = [F.col(f"p_{category}") >= s for s in steps], F.col(category) == 1
    sums = [x for h in hit for x in (F.count_if(h & truth), F.count_if(h))]
    total, *counts = rows.agg(F.count_if(truth), *sums).first()
    scores = [2 * counts[2 * i] / max(1, counts[2 * i + 1] + total) for i in range(len(steps))]
    best = [s for s, score in zip(steps, scores, strict=True) if score == max(scores)]
    return (best[0] + best[-1]) / 2


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id``, ``p_<category>`` and ``<category>`` (whether the probability
    reaches the category's threshold) for every row of ``docs``, over the whole
    text, however long; a text without known words, null included, gets the
    chain's answer to no words.  Repeated rows get equal rows, an empty table none."""
    names = [f"p_{c}" for c in chain.categories]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            p = chain.probabilities(batch.column("text"))
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(p[:, k]) for k in range(len(names))]], names=["doc_id", *names])

    scored = docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, " + ", ".join(f"{n} double" for n in names))
    verdicts = zip(chain.categories, chain.thresholds, strict=True)
    return scored.select("*", *[(F.col(f"p_{c}") >= t).alias(c) for c, t in verdicts])
