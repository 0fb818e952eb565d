"""Toxicity by a classifier chain.

The categories have an order. The linear model of each sees the words of a document and the
probabilities of all categories before it. For training these are out-of-fold predictions: a
document's earlier categories are predicted by models that have not seen it, as they will be for
documents without labels.

A model is a logistic regression on the presence of words (runs of letters and digits in lower
case) and of their beginnings, which catch the inflected forms of a stem. It is fitted to a sample of
``max_rows`` labelled documents at most, those with the smallest hashes of their id; the features
kept are those whose presence differs clearly (``min_z``) between the classes of some category. Tasks
take the features out of the sample's texts and count them; the driver gets the kept features and
which document has which, never a text, and fits the models. Every document is scored by its whole
text.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ship_code, stored

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class ToxicityParams:
    categories: tuple[str, ...] = ("low_quality", "toxic")
    max_rows: int = 5000
    min_docs: int = 5
    min_z: float = 5.0
    folds: int = 3
    penalty: float = 0.1
    steps: int = 300
    threshold: float = 0.4


#: Lengths of the beginnings of words; a longer word has them as features of their own.
BEGINNINGS = (4, 5, 6)
#: Words whose features a worker remembers.
REMEMBERED = 50_000


def words_in(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def forms(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def features_in(text: str | None) -> set[str]:
    return {f for w in words_in(text) for f in forms(w)}


class _Places(dict):
    """Of each word the places of its features in a vocabulary."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        places = tuple(self.vocabulary[f] for f in forms(word) if f in self.vocabulary)
        if len(self) < REMEMBERED:
            self[word] = places
        return places


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray
    bias: float

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> Linear:
    """Logistic regression with a squared penalty by accelerated gradient steps; the share of the
    class alone if there is one class."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    w = np.zeros(x.shape[1])
    if len(y) == 0 or y.min() == y.max():
        return Linear(w, float(bias if len(y) else -30.0))
    # the largest curvature bounds the step
    v = np.ones(x.shape[1]) / np.sqrt(max(1, x.shape[1]))
    for _ in range(20):
        v = x.T @ (x @ v)
        norm = float(np.linalg.norm(v))
        v = v / norm if norm else v
    rate = 1 / (0.25 * (norm + len(y)) + penalty)
    w_ahead, b_ahead, momentum = w, bias, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(x @ w_ahead + b_ahead, -30, 30))) - y
        w_new = w_ahead - rate * (x.T @ error + penalty * w_ahead)
        b_new = b_ahead - rate * float(error.sum())
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        w_ahead = w_new + (momentum - 1) / following * (w_new - w)
        b_ahead = b_new + (momentum - 1) / following * (b_new - bias)
        w, bias, momentum = w_new, b_new, following
    return Linear(w, bias)


@dataclass(frozen=True)
class Chain:
    """Feature places and one model a category, in order."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    models: tuple[Linear, ...] = ()

    @functools.cached_property
    def places(self) -> _Places:
        return _Places(self.vocabulary)

    def __getstate__(self) -> dict:
        return {"vocabulary": self.vocabulary, "models": self.models}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)

    def features(self, texts: Sequence[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.vocabulary)), dtype=np.float32)
        places = self.places
        for i, text in enumerate(texts):
            for word in words_in(text):
                if at := places[word]:
                    x[i, at] = 1
        return x

    def chances(self, texts: Sequence[str | None]) -> np.ndarray:
        x = self.features(texts).astype(np.float64)
        out = np.zeros((len(texts), len(self.models)))
        for c, model in enumerate(self.models):
            out[:, c] = model.chance(np.hstack([x, out[:, :c]]))
        return out


def chosen_features(texts: Sequence[str | None], y: np.ndarray, p: ToxicityParams) -> dict[str, int]:
    """Features in min_docs documents or more whose shares differ by min_z standard errors or more
    between the classes of some category."""
    seen: Counter = Counter()
    among: list[Counter] = [Counter() for _ in range(y.shape[1])]
    for text, row in zip(texts, y, strict=True):
        found = features_in(text)
        seen.update(found)
        for c in np.flatnonzero(row):
            among[c].update(found)
    score = {w: 0.0 for w, n in seen.items() if n >= p.min_docs}
    for c, within in enumerate(among):
        ones = int(y[:, c].sum())
        zeros = len(y) - ones
        if not ones or not zeros:
            continue
        for w in score:
            n, k = seen[w], within[w]
            share = n / len(y)
            spread = math.sqrt(max(share * (1 - share), 1e-9) * (1 / ones + 1 / zeros))
            score[w] = max(score[w], abs(k / ones - (n - k) / zeros) / spread)
    return {w: i for i, w in enumerate(sorted(w for w in score if score[w] >= p.min_z))}


def fit_chain(texts: Sequence[str | None], labels: np.ndarray, p: ToxicityParams) -> Chain:
    """The chain of texts at hand; labels: 0 or 1 for each text and category."""
    vocabulary = chosen_features(texts, labels, p)
    return fit_models(vocabulary, Chain(vocabulary).features(texts), labels, p)


def fit_models(
    vocabulary: dict[str, int], presence: np.ndarray, labels: np.ndarray, p: ToxicityParams
) -> Chain:
    """presence: 0 or 1 for each document and feature place. Fold of the i-th document: i modulo
    folds. The driver holds the features as numbers once, and once more those outside a fold."""
    n, m = labels.shape
    if not n:
        return Chain({}, tuple(Linear(np.zeros(c), -30.0) for c in range(m)))
    v = presence.shape[1]
    x = np.hstack([presence, np.zeros((n, m))])  # features, then the earlier categories' predictions
    fold = np.arange(n) % p.folds
    models = []
    for c in range(m):
        xc, y = x[:, : v + c], labels[:, c].astype(np.float64)
        models.append(fit_linear(xc, y, p.penalty, p.steps))
        if c + 1 < m:
            for k in range(p.folds):
                if (fold == k).any():
                    other = fit_linear(xc[fold != k], y[fold != k], p.penalty, p.steps)
                    x[fold == k, v + c] = other.chance(xc[fold == k])
    return Chain(vocabulary, tuple(models))


def _features(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: sorted(features_in(text)))


def labelled_sample(docs: DataFrame, labels: DataFrame, p: ToxicityParams) -> DataFrame:
    """Stored rows (doc_id, 0 or 1 for each category, features) of max_rows documents at most, from
    labels with the columns doc_id and one per category; rows without an id or any label are left
    out, of repeated ids the largest labels and text count.

    The sample is drawn from ids; its max_rows ids at most are then broadcast to the texts, which
    are read once and not shuffled but for those of the sample.
    """
    usable = labels.where(F.col("doc_id").isNotNull()).select("doc_id", *p.categories).dropna()
    positive = [F.max((F.col(c).cast("int") > 0).cast("int")).alias(c) for c in p.categories]
    present = usable.groupBy("doc_id").agg(*positive)
    present = present.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = stored(present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_rows), "labelled")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one_each = texts.groupBy("doc_id", *p.categories).agg(F.max("text").alias("text"))
    features = F.pandas_udf(_features, "array<string>")
    ship_code(docs.sparkSession)
    return stored(one_each.select("doc_id", *p.categories, features("text").alias("features")), "sample")


def counted_features(sample: DataFrame, totals: Sequence[int], p: ToxicityParams) -> DataFrame:
    """Rows (feature) that ``chosen_features`` would choose, by counts over the sample's rows;
    totals: the number of rows, then that of ones in each category."""
    n, *ones = totals
    held = sample.select(F.explode("features").alias("feature"), *p.categories)
    counts = held.groupBy("feature").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(f"k{i}") for i, c in enumerate(p.categories)]
    )
    share = F.col("n") / n
    differing = F.lit(p.min_z <= 0)
    for i, k in enumerate(ones):
        if 0 < k < n:
            among = F.col(f"k{i}")
            gap = F.abs(among / k - (F.col("n") - among) / (n - k))
            spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / k + 1 / (n - k)))
            differing = differing | (gap / spread >= p.min_z)
    return counts.where((F.col("n") >= p.min_docs) & differing).select("feature")


def classifier_chain(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> Chain:
    """The chain fitted to the labelled documents; without any, one that calls nothing."""
    sample = labelled_sample(docs, labels, params)
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in params.categories]
    totals = sample.agg(F.count("*"), *sums).first()
    if not totals[0]:
        return fit_models({}, np.zeros((0, 0)), np.zeros((0, len(params.categories))), params)
    kept = stored(counted_features(sample, totals, params), "features")
    return fit_models(*_presence(sample, kept, params), params)


def _presence(
    sample: DataFrame, kept: DataFrame, p: ToxicityParams
) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """The kept features' places, which document of the sample has which, and the documents' labels."""
    vocabulary = {r["feature"]: i for i, r in enumerate(kept.orderBy("feature").collect())}
    held = sample.select("doc_id", F.explode("features").alias("feature")).join(kept, "feature")
    held = held.groupBy("doc_id").agg(F.collect_list("feature").alias("held"))
    rows = sample.select("doc_id", *p.categories).join(held, "doc_id", "left").collect()
    rows.sort(key=lambda r: r["doc_id"])
    presence = np.zeros((len(rows), len(vocabulary)), dtype=np.bool_)
    for i, row in enumerate(rows):
        presence[i, [vocabulary[f] for f in row["held"] or ()]] = True
    return vocabulary, presence, np.array([[r[c] for c in p.categories] for r in rows], dtype=np.int64)


def with_chances(docs: DataFrame, chain: Chain, params: ToxicityParams, name: str) -> DataFrame:
    """docs with a struct column of each category's probability; all rows and columns stay, a null
    or empty text is scored as one without words, a column of that name is replaced."""
    ship_code(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    categories = list(params.categories)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values = texts.to_list()
            parts = [sent.value.chances(values[i : i + 500]) for i in range(0, len(values), 500)]
            yield pd.DataFrame(np.vstack(parts) if parts else np.zeros((0, len(categories))), columns=categories)

    scored = F.pandas_udf(run, ", ".join(f"`{c}` double" for c in categories))
    return docs.withColumn(name, scored(F.col("text")))


def production_labels(labels: DataFrame) -> DataFrame:
    """The labels table (doc_id, quality, toxic) as the chain's categories."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
