"""Toxicity by a chain of classifiers.

The categories stand in an order; the model of a category is linear (logistic)
over the words of the text and over the probabilities of all earlier
categories. For training, those earlier probabilities come from models that
have not seen the row: the rows are cut into ``FOLDS`` folds by a hash of the
id, and each fold is predicted by a model of the others (out of fold). At
prediction time the models of all rows are chained.

Words are lower-cased runs of letters; a text has each of its words and each
word's beginnings of ``PREFIXES`` letters as features, present or not. The
``FEATURES`` features that tell any category best are kept: counted by Spark
over the training rows, ranked by the chi-square of their counts, and scaled by
its root in the fit, so that the penalty falls least on those that tell most.

Training rows: at most ``TRAIN_ROWS`` labelled documents, those with the
smallest hash of their id (a documented bound; the matrix of the fit has
``TRAIN_ROWS`` x ``FEATURES`` cells at most). Prediction reads all whole texts.

Defined cases: a null text is the empty text; a label that is null counts as
missing and leaves the row out of training; several labels of a document count
by their maximum; with no labels, or only one class of a category, its
probability is that class's share (0 without labels); a repeated row gives a
repeated result row; an empty table an empty result; other columns pass by
unread (``reject_toxic`` keeps the columns it is given).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import table, text_or_empty

#: (category, expression over the labels table), in the order of the chain.
CATEGORIES = (("low_quality", "1 - quality"), ("toxic", "toxic"))
TRAIN_ROWS = 8192
FEATURES = 2048
FOLDS = 4
PREFIXES = (3, 4, 5, 6)
STEPS = 300
#: Weight of the squared coefficients, and from which probability a text is rejected.
RIDGE = 1e-4
THRESHOLD = 0.5

_LETTERS = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    words = set(_LETTERS.findall(text.lower()))
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "-" for w in words if len(w) > n])
    return out


@dataclass
class Chain:
    """Per category the intercept, the weights of the words and those of earlier categories."""
    categories: tuple[str, ...]
    index: dict[str, int]
    models: list[tuple[float, np.ndarray, np.ndarray]] = field(default_factory=list)

    def predict(self, found: list[list[int]]) -> np.ndarray:
        """Probabilities (rows x categories) of rows given by their feature numbers."""
        out = np.zeros((len(found), len(self.categories)))
        sizes = [len(f) for f in found]
        flat = np.fromiter((i for f in found for i in f), np.int64, sum(sizes))
        row = np.repeat(np.arange(len(found)), sizes)
        for k, (bias, words, earlier) in enumerate(self.models):
            z = bias + np.bincount(row, words[flat], len(found)) + out[:, :k] @ earlier
            out[:, k] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def fit_logistic(z: np.ndarray, y: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Weights of the columns of ``z`` (the last is 1) by ridge logistic regression over the rows
    in ``use``, in accelerated gradient steps; one class gives its share."""
    w = np.zeros(z.shape[1], np.float32)
    n = max(1, int(use.sum()))
    share = float(y[use].sum()) / n
    if share in (0.0, 1.0):
        w[-1] = 30.0 if share else -30.0
        return w
    on = use.astype(np.float32)
    v = np.random.default_rng(0).normal(size=z.shape[1]).astype(np.float32)
    for _ in range(12):  # the largest singular value bounds the curvature
        v = z.T @ (on * (z @ v))
        norm = float(np.linalg.norm(v))
        v /= norm
    rate = 1.0 / (0.25 * norm / n + RIDGE)
    w[-1] = np.log(share / (1 - share))
    ahead = w.copy()
    for step in range(STEPS):
        grad = z.T @ ((on * (sigmoid(z @ ahead) - y)).astype(np.float32) / n)
        grad[:-1] += RIDGE * ahead[:-1]
        new = ahead - rate * grad
        ahead = new + step / (step + 3) * (new - w)
        w = new
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_chain(found: list, labels: np.ndarray, fold: np.ndarray, categories: tuple[str, ...],
              index: dict[str, int], scale: np.ndarray | None = None) -> Chain:
    """``found``: the feature numbers of each row; ``scale``: the value of a feature in the fit."""
    n, size, count = len(found), len(index), len(categories)
    scale = np.ones(size) if scale is None else scale
    z = np.zeros((n, size + count + 1), np.float32)  # features, earlier categories, 1; the only large array
    z[:, -1] = 1
    for r, f in enumerate(found):
        if f is not None and len(f):
            z[r, np.asarray(f, int)] = scale[np.asarray(f, int)]
    chain, every = Chain(categories, index), np.ones(n, bool)
    for k in range(count):
        w = fit_logistic(z, labels[:, k], every).astype(float)
        chain.models.append((w[-1], w[:size] * scale, w[size:size + k]))
        if k + 1 < count:
            out_of_fold = np.zeros(n, np.float32)
            for f in range(FOLDS):
                held = fold == f
                out_of_fold[held] = sigmoid(z @ fit_logistic(z, labels[:, k], ~held))[held]
            z[:, size + k] = out_of_fold
    return chain


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          categories: tuple[tuple[str, str], ...] = CATEGORIES) -> Chain:
    names = tuple(c for c, _ in categories)
    marks = (labels.groupBy(F.col(id_col).alias("id"))
             .agg(*[F.max(F.expr(e)).cast("int").alias(f"y_{c}") for c, e in categories]).dropna())
    sample = marks.orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)  # a bounded table, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("content")).join(F.broadcast(sample), "id")

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 200):
                part = pdf.iloc[k:k + 200]
                found = [sorted(features(t)) for t in part["content"]]
                yield part.drop(columns="content").assign(feature=found).explode("feature").dropna()

    marked = ", ".join(f"y_{c} int" for c in names)
    pairs = rows.dropDuplicates(["id"]).mapInPandas(explode, f"id {rows.schema['id'].dataType.simpleString()}, {marked}, feature string")
    pairs = pairs.select("id", "feature", *[f"y_{c}" for c in names])
    totals = rows.dropDuplicates(["id"]).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y_{c}").alias(c) for c in names]).first()
    n = totals["n"]
    if not n:
        return Chain(names, {}, [(-30.0, np.zeros(0), np.zeros(k)) for k in range(len(names))])
    counts = pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("f"), *[F.sum(f"y_{c}").alias(c) for c in names])
    f = F.col("f").cast("double")

    def chi_square(c: str):
        pos = float(totals[c])
        off = F.col(c) * n - f * pos
        return off * off / (f * (n - f + 0.5) * (pos + 0.5) * (n - pos + 0.5))

    best = (counts.filter(F.col("f") > 2).withColumn("tells", F.greatest(*[chi_square(c) for c in names], F.lit(0.0)))
            .orderBy(F.desc("tells"), "feature").limit(FEATURES).select("feature", "tells").collect())
    scale = np.sqrt([r["tells"] for r in best])
    index = {r["feature"]: i for i, r in enumerate(best)}
    kept = docs.sparkSession.createDataFrame([(k, i) for k, i in index.items()], "feature string, i int")
    listed = (pairs.join(F.broadcast(kept), "feature")
              .groupBy("id").agg(F.collect_list("i").alias("found")))  # at most FEATURES numbers a row
    data = (sample.join(listed, "id", "left").join(rows.select("id").distinct(), "id", "left_semi")
            .withColumn("fold", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS))).orderBy("id").toPandas())
    return fit_chain(data["found"].tolist(), data[[f"y_{c}" for c in names]].to_numpy(float), data["fold"].to_numpy(),
                     names, index, scale)


def predict(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` with a probability column ``p_<category>`` for each category, all columns kept."""
    probability = F.pandas_udf(lambda s: _scored(s, chain), "array<double>")
    with_p = docs.withColumn("__p", probability(text_or_empty(text_col)))
    return with_p.withColumns({f"p_{c}": F.col("__p")[k] for k, c in enumerate(chain.categories)}).drop("__p")


def _scored(texts: pd.Series, chain: Chain) -> pd.Series:
    index = chain.index
    known = index.keys()
    out: list[np.ndarray] = []
    for k in range(0, len(texts), 500):
        found = [[index[f] for f in features(t) & known] for t in texts.iloc[k:k + 500]]
        out += list(chain.predict(found))
    return pd.Series(out, index=texts.index)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: the probability of each category, and whether the text is rejected as toxic."""
    docs = table(spark, sf_dir, "documents")
    chain = train(docs, table(spark, sf_dir, "labels"))
    return predict(docs.select("doc_id", "text"), chain).select(
        "doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= THRESHOLD).alias("toxic"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the texts that the chain trained on their labelled rows calls toxic."""
    chain = train(docs, labels)
    kept = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    return predict(kept, chain).filter(F.col("p_toxic") < THRESHOLD).select("row.*")
