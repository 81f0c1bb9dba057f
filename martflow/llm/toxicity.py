"""Toxicity score: FTRL-proximal logistic regression over hashed word n-grams.

Features are words, pairs of adjacent words and pairs with one word between
(skip-grams), lower-cased in ASCII and hashed into ``2**HASH_BITS`` places; a
place counts once per text.  FTRL-proximal gives every place its own learning
rate and sets weights without enough evidence to exactly zero (L1), so the
model is a short sorted list of places and weights that goes to the tasks
with the closure.

Fitting uses at most ``SAMPLE`` labelled documents (a documented bound), dealt
by id hash to ``LEARNERS`` tasks, whose weights are averaged, and one share
that calibrates the result.  Everything else reads all rows.

Edge cases: null, empty or word-less text is scored by the intercept; without
labelled rows of both classes every score is 0.5; unlabelled, null or
contradicting labels are not used; texts of any length are scored whole, in
pieces of bounded memory; repeated rows get equal scores; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm import words as W
from martflow.llm.common import labelled_sample, logistic

SAMPLE = 16_000
LEARNERS = 3
EPOCHS = 4
HASH_BITS = 24
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 1.0
GRAMS = ((0,), (0, 1), (0, 2))


class Model(NamedTuple):
    places: np.ndarray  # sorted
    weights: np.ndarray
    intercept: float


def features(raw: np.ndarray, at: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place) of every feature, sorted, each once per text; only ``wanted`` (mask) places."""
    w = W.words(raw, at, W.ALNUM)
    found = []
    for gaps in GRAMS:
        h, doc = (w.hash, w.doc) if gaps == (0,) else W.combine(w, *gaps)
        place = (h >> np.uint64(64 - HASH_BITS)).astype(np.int64)
        if wanted is not None:
            hit = wanted[place]
            place, doc = place[hit], doc[hit]
        found.append(doc.astype(np.int64) << HASH_BITS | place)
    both = np.unique(np.concatenate(found))
    return both >> HASH_BITS, both & (1 << HASH_BITS) - 1


class Learner:
    """FTRL-proximal state; the last place is the intercept, without L1."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << HASH_BITS) + 1, np.float32)
        self.n = np.zeros((1 << HASH_BITS) + 1, np.float32)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 1 << HASH_BITS, 0, L1).astype(np.float32)
        return np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def learn(texts: pa.Array, y: list[int], epochs: int = EPOCHS) -> Learner:
    rows = []
    bias = np.array([1 << HASH_BITS])
    for low, high in W.slices(texts):
        doc, place = features(*W.buffer_of(texts.slice(low, high - low)))
        parts = np.split(place, np.searchsorted(doc, np.arange(1, high - low)))
        rows += [np.concatenate([p, bias]) for p in parts]
    learner = Learner()
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            learner.learn(rows[i], y[i])
    return learner


def _learn_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = list(it)  # a learner's share of the bounded sample
    if not batches:
        return
    rows = pa.Table.from_batches(batches).sort_by("doc_id")
    learner = learn(rows["text"].combine_chunks().cast(pa.large_string()), rows["y"].to_pylist())
    at = np.append(np.flatnonzero(np.abs(learner.z[:-1]) > L1), 1 << HASH_BITS)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(learner.weights(at).astype(np.float64))], ["place", "weight"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held: int = 0,
        sample: int = SAMPLE) -> Model | None:
    """Weights from labelled rows outside the held-out fold; None without both classes."""
    rows = labelled_sample(docs, labels, label, folds, held, sample)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(LEARNERS + 1))  # the last share calibrates
    rows = rows.withColumn("share", share)
    parts = rows.where(F.col("share") < LEARNERS).repartitionByRange(LEARNERS, "share").select("doc_id", "y", "text")
    found = parts.mapInArrow(_learn_batches, "place long, weight double")
    mean = found.groupBy("place").agg((F.sum("weight") / LEARNERS).alias("weight")).orderBy("place").toPandas()
    bias = mean.place == 1 << HASH_BITS
    if not bias.any() or not (~bias).any():
        return None
    model = Model(mean.place[~bias].to_numpy(np.int64), mean.weight[~bias].to_numpy(), float(mean.weight[bias].iloc[0]))
    # Averaged weights are too small by the learners that left a place at zero:
    # a slope and shift from documents that no learner has seen mend it.
    seen = rows.where(F.col("share") == LEARNERS).select("y", "text").mapInArrow(_margin_batches(model), "y int, margin double").toPandas()
    slope, shift = logistic(seen[["margin"]].to_numpy(), seen["y"].to_numpy())
    return Model(model.places, model.weights * slope, model.intercept * slope + shift)


def _margin_batches(model: Model):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column("y").cast(pa.int32()), pa.array(margins(b.column("text"), model))], ["y", "margin"])
    return batches



def score_texts(texts: pa.Array, model: Model | None) -> np.ndarray:
    """Probability of the label for each text."""
    if model is None:
        return np.full(len(texts), 0.5)
    return 1 / (1 + np.exp(-np.clip(margins(texts, model), -30, 30)))


def margins(texts: pa.Array, model: Model) -> np.ndarray:
    """Log-odds of each text: intercept and the weights of its places."""
    wanted = np.zeros(1 << HASH_BITS, bool)
    wanted[model.places] = True
    out = np.empty(len(texts))
    for low, high in W.slices(texts):
        doc, place = features(*W.buffer_of(texts.slice(low, high - low)), wanted)
        weight = model.weights[np.searchsorted(model.places, place)]
        out[low:high] = model.intercept + np.bincount(doc, weight, high - low)
    return out


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every document, whole texts."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score_texts(b.column("text"), model))], ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(batches, "doc_id long, score double")
