"""Quality by naive Bayes support vectors.

A document's features are the indicators of its token n-grams (one and two tokens) and of the n-grams
(one to three) of its token shapes: case, digits, marks, and whether a token repeats the one or the two
before it. Every indicator is scaled by the class log-count ratio of its n-gram, and a linear
hinge-loss model is fitted on the scaled vectors by dual coordinate descent. Margins are calibrated to
probabilities on a part of the sample that the model has not seen.

Null and empty texts have no n-grams and get the score of the intercept. Repeated rows get equal scores.
Without rows of both classes the score is the smoothed share of label 1.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Hashable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import shared
from ledgerloom.llm.op7_toxicity import _logistic

# The documented bound of the training sample: texts of each class, and their length.
SAMPLE_PER_CLASS = 2_500
SAMPLE_CHARS = 20_000
LEAST_DOCUMENTS = 4
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 30
THRESHOLD = 0.3

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+|\n")


@dataclass(frozen=True)
class Model:
    weights: dict[Hashable, float]
    bias: float
    slope: float
    intercept: float


def _shape(token: str) -> str:
    if token.isalpha():
        return "U" if token.isupper() and len(token) > 1 else "l" if token.islower() else "C"
    return "9" if token[0].isalnum() else token[:3]


def features(text: str) -> set[Hashable]:
    tokens = _TOKEN.findall(text)
    known = {t: _shape(t) for t in set(tokens)}
    shapes = [known[t] for t in tokens]
    for i, (a, b) in enumerate(zip(tokens, tokens[1:], strict=False), 1):
        if a == b:
            shapes[i] = "="
    for i, (a, b) in enumerate(zip(tokens, tokens[2:], strict=False), 2):
        if a == b and shapes[i] != "=":
            shapes[i] = '"'
    lower = text.lower()
    words = tokens if lower == text else _TOKEN.findall(lower)
    found: set[Hashable] = set(words)
    found.update(zip(words, words[1:], strict=False))
    found.update((0, s) for s in set(shapes))
    found.update((1, a, b) for a, b in set(zip(shapes, shapes[1:], strict=False)))
    found.update((2, a, b, c) for a, b, c in set(zip(shapes, shapes[1:], shapes[2:], strict=False)))
    return found


def log_count_ratios(rows: list[tuple[set[Hashable], int]]) -> dict[Hashable, float]:
    """By n-gram: the log of its smoothed share among the n-grams of class 1 over that of class 0."""
    counts: tuple[Counter[Hashable], Counter[Hashable]] = (Counter(), Counter())
    for found, label in rows:
        counts[label].update(found)
    both = sorted(counts[0].keys() | counts[1].keys(), key=repr)
    kept = [f for f in both if counts[0][f] + counts[1][f] >= LEAST_DOCUMENTS]
    n = [sum(label == y for _, label in rows) for y in (0, 1)]
    share = lambda f, y: (counts[y][f] + SMOOTHING) / (n[y] + 2 * SMOOTHING)
    return {f: math.log(share(f, 1) / share(f, 0)) for f in kept}


def dual_coordinate_descent(
    vectors: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray, width: int
) -> np.ndarray:
    """Weights of the L2-regularised squared hinge loss; each vector is (positions, values)."""
    w = np.zeros(width)
    alpha = np.zeros(len(vectors))
    extra = 1 / (2 * costs)
    norms = np.array([v @ v for _, v in vectors]) + extra
    order = np.arange(len(vectors))
    shuffle = np.random.default_rng(7)
    for _ in range(EPOCHS):
        shuffle.shuffle(order)
        moved = 0.0
        for i in order:
            at, value = vectors[i]
            slack = signs[i] * (w[at] @ value) - 1 + extra[i] * alpha[i]
            if alpha[i] == 0 and slack >= 0:
                continue
            fresh = max(alpha[i] - slack / norms[i], 0.0)
            step = (fresh - alpha[i]) * signs[i]
            w[at] += step * value
            moved = max(moved, abs(slack))
            alpha[i] = fresh
        if moved < 1e-3:
            break
    return w


def _margin(found: set[Hashable], weights: dict[Hashable, float], bias: float) -> float:
    hit = [weights[f] for f in found if f in weights]
    return math.fsum(hit) / math.sqrt(len(hit) + 1) + bias  # exact, so in any order of the set


def fit(sample: list[tuple[str, int]], share: float) -> Model:
    """`share` is the share of label 1 among all training labels, not in the sample."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    prior = math.log(share / (1 - share))
    rows = [(features(t), y) for t, y in sample]
    split = [i % 4 == 0 for i in range(len(rows))]
    learn = [r for r, late in zip(rows, split, strict=True) if not late]
    check = [r for r, late in zip(rows, split, strict=True) if late]
    if any(len({y for _, y in part}) < 2 for part in (learn, check)):
        return Model({}, 0.0, 0.0, prior)
    ratios = log_count_ratios(learn)
    place = {f: i for i, f in enumerate(ratios)}
    scale = np.array([*ratios.values(), 1.0])
    vectors = []
    for found, _ in learn:
        at = np.sort(np.array([place[f] for f in found if f in place], dtype=np.int64))
        vectors.append((np.append(at, len(ratios)), np.append(scale[at] / math.sqrt(len(at) + 1), 1.0)))
    signs = np.array([1.0 if y else -1.0 for _, y in learn])
    each = np.array([COST / (2 * (signs == s).mean()) for s in signs])
    w = dual_coordinate_descent(vectors, signs, each, len(scale))
    weights = {f: float(w[i] * scale[i]) for f, i in place.items() if abs(w[i] * scale[i]) > 1e-6}
    bias = float(w[-1])
    margins = np.array([_margin(found, weights, bias) for found, _ in check])
    labels = np.array([y for _, y in check], dtype=float)
    slope, intercept = _logistic(margins, labels)
    ones = labels.mean()
    return Model(weights, bias, slope, intercept + prior - math.log(ones / (1 - ones)))


def train(documents: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    known = shared.training_labels(labels, "quality", 5, 0)
    total, ones = known.agg(F.count("label"), F.sum("label")).first()
    sample = shared.labelled_sample(documents, known, sample_per_class, SAMPLE_CHARS)
    return fit(sample, ((ones or 0) + 1) / (total + 2))


def score(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            margins = np.array([_margin(features(t), model.weights, model.bias) for t in texts], dtype=float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(model.slope * margins + model.intercept, -700, 700))))

    return scored(F.coalesce(text, F.lit("")))


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its score and the decision at the threshold."""
    model = train(documents, labels)
    scored = documents.select(
        "doc_id", shared.held_out(F.col("doc_id"), 5, 0).alias("held_out"), score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
