"""Toxicity by compression distance.

Two raw-content zstandard dictionaries are trained: one on ordinary text, one that holds in front of the
same content what toxic text has and ordinary text lacks: a dictionary trained on the words whose share of
toxic texts stands out. (Dictionaries trained on the whole texts of each class find 0.3 of the toxic texts of
sf0.1 at 4 % of the clean ones: what both classes share fills them, and its chance differences drown the
rest.) Every text is cut into windows of a few words, each window is
compressed with both, and the difference in length is the window's gain. A document's evidence is the
sum over all its windows of the log-likelihood ratio of their gains, measured on texts that the dictionaries
have not seen. The evidence that parts the labelled sample best (F measure at the true class shares) is
calibrated to the score 0.3, the decision threshold.

Fitted on at most `SAMPLE_PER_CLASS` texts of each class of at most `SAMPLE_CHARS` characters, chosen by a hash
of the id; the ordinary dictionary on at most 40,000 evenly spaced pieces of 256 bytes of those. Scores cover
all rows and whole texts.

Null and empty texts have one empty window and get a score like any other. Repeated rows get equal
scores. Without rows of both classes the score is the smoothed share of label 1 (0.5 if unlabelled).
Any other columns pass through untouched.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import shared

# The documented bound of the training sample: texts of each class, and their length.
SAMPLE_PER_CLASS = 2_500
SAMPLE_CHARS = 20_000
WINDOW_WORDS = 8
DICTIONARY_BYTES = 65_536
TOXIC_BYTES = 2_048
# A term belongs in the toxic dictionary if its share of toxic texts exceeds that of ordinary ones
# by this many standard errors.
TERM_Z = 5.0
THRESHOLD = 0.3
FOLDS = 3
# How much more a missed toxic text counts than a clean one called toxic, when the threshold is set.
RECALL_WEIGHT = 1.5
GAIN_LOW, GAIN_HIGH = -6, 12

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    evidence: tuple[float, ...]
    slope: float
    intercept: float


def windows(text: str) -> list[bytes]:
    words = text.lower().split()
    return [
        " ".join(words[i : i + WINDOW_WORDS]).encode("utf-8", "surrogatepass")
        for i in range(0, len(words), WINDOW_WORDS)
    ] or [b""]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=5, min_match=5, target_length=16,
        strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


def gains(text: str, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> np.ndarray:
    """Bytes that the toxic dictionary saves in each window, clipped to the calibrated range."""
    saved = [len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text)]
    return np.clip(saved, GAIN_LOW, GAIN_HIGH) - GAIN_LOW


def toxic_terms(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Words that set toxic texts apart, the strongest first."""
    if not toxic or not ordinary:
        return []

    def frequencies(texts: list[str]) -> Counter[str]:
        return Counter(w for t in texts for w in set(_WORD.findall(t.lower())))

    a, b = frequencies(toxic), frequencies(ordinary)
    m, n = len(toxic), len(ordinary)

    def z(word: str) -> float:
        pooled = (a[word] + b[word]) / (m + n)
        spread = math.sqrt(pooled * (1 - pooled) * (1 / m + 1 / n))
        return (a[word] / m - b[word] / n) / spread if spread else 0.0

    strong = [(z(w), w) for w in a if len(w) >= 3 and a[w] >= 3]
    return [w for value, w in sorted(strong, key=lambda x: (-x[0], x[1])) if value > TERM_Z]


def _trained(size: int, samples: list[bytes]) -> bytes:
    if not samples:
        return b" "
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples for the trainer: take them as they are
        return b" ".join(samples)[:size]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    pieces = []
    for text in ordinary:
        raw = text.lower().encode("utf-8", "surrogatepass")
        pieces += [raw[i : i + 256] for i in range(0, len(raw), 256)]
    base = _trained(DICTIONARY_BYTES, pieces[:: max(1, len(pieces) // 20_000)])
    terms = toxic_terms(toxic, ordinary)
    known = set(terms)
    used = [[w for w in _WORD.findall(t.lower()) if w in known] for t in toxic]
    learned = _trained(TOXIC_BYTES, [f" {' '.join(ws)} ".encode() for ws in used if ws]) if terms else b""
    missing = [w for w in reversed(terms) if f" {w} ".encode() not in learned]
    return base, learned + f" {' '.join(missing)} ".encode() + base


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by damped Newton steps with a small ridge."""
    w = np.zeros(2)
    features = np.column_stack([x, np.ones_like(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        gradient = features.T @ (p - y) + 1e-2 * w
        curvature = (features * (p * (1 - p))[:, None]).T @ features + 1e-2 * np.eye(2)
        w -= np.clip(np.linalg.solve(curvature, gradient), -1, 1)
    return float(w[0]), float(w[1])


def fit(sample: list[tuple[str, int]], share: float) -> Model:
    """`share` is the share of label 1 among all training labels, not in the sample."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    prior = math.log(share / (1 - share))
    toxic, ordinary = [t for t, y in sample if y == 1], [t for t, y in sample if y == 0]
    if not toxic or not ordinary:
        return Model(b" ", b" ", (0.0,) * (GAIN_HIGH - GAIN_LOW + 1), 0.0, prior)
    measured = []
    for fold in range(FOLDS):  # gains of texts that the dictionaries have not seen
        rest = [r for i, r in enumerate(sample) if i % FOLDS != fold]
        pair = dictionaries([t for t, y in rest if y == 1], [t for t, y in rest if y == 0])
        one, two = compressor(pair[0]), compressor(pair[1])
        measured += [(gains(t, one, two), y) for i, (t, y) in enumerate(sample) if i % FOLDS == fold]
    counts = np.full((2, GAIN_HIGH - GAIN_LOW + 1), 0.5)
    for g, y in measured:
        np.add.at(counts[y], g, 1)
    evidence = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    x = np.clip([evidence[g].sum() for g, _ in measured], -30, 30)
    y = np.asarray([label for _, label in measured])
    slope = max(_logistic(np.asarray(x), y.astype(float))[0], 0.1)
    cut = best_cut(np.asarray(x), y, share)
    base, contrast = dictionaries(toxic, ordinary)
    return Model(base, contrast, tuple(evidence), slope, math.log(THRESHOLD / (1 - THRESHOLD)) - slope * cut)


def best_cut(x: np.ndarray, y: np.ndarray, share: float) -> float:
    """The value from which calling a text toxic has the best F measure, if `share` of all texts are toxic."""
    weight = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum())
    order = np.argsort(-x, kind="stable")
    right = np.cumsum((weight * y)[order])
    called = np.cumsum(weight[order])
    beta = RECALL_WEIGHT**2
    measure = (1 + beta) * right / (called + beta * share)
    ends = np.append(np.diff(x[order]) != 0, True)  # equal values fall on one side
    best = int(np.argmax(np.where(ends, measure, -1)))
    below = x[order][best + 1] if best + 1 < len(x) else x[order][best] - 1
    return float((x[order][best] + below) / 2)


def train(documents: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> Model:
    known = shared.training_labels(labels, "toxic", 4, 2)
    total, ones = known.agg(F.count("label"), F.sum("label")).first()
    sample = shared.labelled_sample(documents, known, sample_per_class, SAMPLE_CHARS)
    return fit(sample, ((ones or 0) + 1) / (total + 2))


def score(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one, two = compressor(model.ordinary), compressor(model.toxic)
        evidence = np.asarray(model.evidence)
        for texts in batches:
            x = [float(np.clip(evidence[gains(t, one, two)].sum(), -30, 30)) for t in texts]
            yield pd.Series(1 / (1 + np.exp(-(model.slope * np.asarray(x, dtype=float) + model.intercept))))

    return scored(F.coalesce(text, F.lit("")))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its score and the decision at the threshold."""
    model = train(documents, labels)
    scored = documents.select(
        "doc_id", shared.held_out(F.col("doc_id"), 4, 2).alias("held_out"), score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject_toxic(documents: DataFrame, training: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with their own columns.

    The model is learned from `training`, the documents that the labels speak of.
    """
    return documents.where(score(F.col("text"), train(training, labels)) < THRESHOLD)
