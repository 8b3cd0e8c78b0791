"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams: words, word pairs (all pairs of a word with
itself count as one) and byte trigrams. Each
is scaled by its class log-count ratio (from the training texts, with one added to
each count), texts are scaled to unit length, and a linear hinge-loss model is
fitted by dual coordinate descent. A fifth of the training texts is held back from
the fit; on it the margin is turned into a probability (Platt).

It is fitted in one task on at most `SAMPLE` labelled texts (the documented bound).
All texts are scored, whole. Null text counts as empty: no indicators, the score is
that of the bare intercept. Without labels of both classes the score is the smoothed
share of label 1. Repeated rows are scored each; an empty table gives an empty
result. Only doc_id and text are read from the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import Words, grams, held_out, pieces_of, ready
from ridelake.llm.supervised import fitted, labelled_sample, platt, sigmoid

#: Bound of the training sample, in texts.
SAMPLE = 8192
WORD_BITS, BYTE_BITS = 18, 15
SIZE = (1 << WORD_BITS) + (1 << BYTE_BITS)
SAME, AGAIN = (np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1) for k in (1, 2))
#: Texts whose byte trigrams are marked at once: a bit table of this many rows.
ROWS = 512


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of each distinct n-gram of each text, ordered by text."""
    words = Words(data, offsets)
    hashes = words.hashes()
    pair = words.full(2)
    pairs = grams(hashes, 2)
    # A word and the same word again is one n-gram whatever the word; so is that twice.
    same = np.append(hashes[1:] == hashes[:-1], False) & pair
    pairs[same] = SAME
    pairs[:-1][same[:-1] & same[1:]] = AGAIN
    row = np.concatenate((words.row, words.row[pair]))
    feature = np.concatenate((hashes, pairs[pair])) >> np.uint64(64 - WORD_BITS)
    by_word = np.unique((row << 32) | feature.astype(np.int64))
    found = [by_word]
    if len(data) > 2:
        code = data.astype(np.uint32)
        tri = (code[:-2] | (code[1:-1] << 8) | (code[2:] << 16)) * np.uint32(0x9E3779B1)
        tri = (tri >> np.uint32(32 - BYTE_BITS)).astype(np.int64)
        at = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = at[:-2] == at[2:]
        seen = np.zeros((len(offsets) - 1) << BYTE_BITS, bool)
        seen[((at[:-2] << BYTE_BITS) + tri)[inside]] = True
        key = np.flatnonzero(seen)
        found.append(((key >> BYTE_BITS) << 32) | ((key & ((1 << BYTE_BITS) - 1)) + (1 << WORD_BITS)))
    key = np.concatenate(found)
    row, feature = key >> 32, key & 0xFFFFFFFF
    order = np.argsort(row, kind="stable")
    return row[order], feature[order].astype(np.int32)


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, features, feature offsets) of blocks of texts."""
    for low, high, data, offsets in pieces_of(column):
        for a in range(0, high - low, ROWS):
            b = min(a + ROWS, high - low)
            own = offsets[a : b + 1]
            row, feature = indicators(data[own[0] : own[-1]], own - own[0])
            yield low + a, low + b, feature, np.searchsorted(row, np.arange(b - a + 1))


@dataclass
class Model:
    weights: np.ndarray
    scale: np.ndarray
    slope: float
    intercept: float

    def margins(self, feature: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Margins of texts whose features lie between successive entries of `at`."""
        if not len(feature):
            return np.zeros(len(at) - 1)
        ratio = self.scale[feature].astype(np.float64)
        total = np.concatenate(([0.0], np.cumsum(ratio * self.weights[feature])))
        length = np.concatenate(([0.0], np.cumsum(ratio * ratio)))
        norm = np.sqrt(np.maximum(length[at[1:]] - length[at[:-1]], 1e-12))
        return (total[at[1:]] - total[at[:-1]]) / norm

    def scores(self, feature: np.ndarray, at: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margins(feature, at) + self.intercept)


def constant(share: float) -> Model:
    none = np.zeros(SIZE, np.float32)
    return Model(none, none, 0.0, float(np.log(share / (1 - share))))


def log_count_ratios(texts: list[np.ndarray], positive: np.ndarray) -> np.ndarray:
    """Log of the share of each indicator in one class over its share in the other."""
    shares = []
    for side in (True, False):
        count = np.ones(SIZE)
        for k in np.flatnonzero(positive == side):
            count[texts[k]] += 1
        shares.append(count / count.sum())
    return np.log(shares[0] / shares[1])


def dual_descent(
    texts: list[np.ndarray], positive: np.ndarray, scale: np.ndarray, cost: float = 1.0, rounds: int = 12, seed: int = 7
) -> np.ndarray:
    """Weights of the hinge-loss model, by coordinate descent on its dual.

    Minimises |w|^2 / 2 + sum of cost_i * max(0, 1 - y_i w.x_i); the cost of a text
    is weighted so that both classes weigh the same.
    """
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, positive.mean(), 1 - positive.mean())
    upper = cost * 0.5 / share
    values = [scale[t] for t in texts]
    norms = [max(float(np.sqrt(v @ v)), 1e-6) for v in values]
    values = [(v / n).astype(np.float32) for v, n in zip(values, norms, strict=True)]
    square = np.array([float(v @ v) for v in values])
    alpha, w = np.zeros(len(texts)), np.zeros(SIZE, np.float32)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(len(texts)):
            if square[i] == 0:
                continue
            gradient = y[i] * float(w[texts[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            if new != alpha[i]:
                w[texts[i]] += np.float32((new - alpha[i]) * y[i]) * values[i]
                worst = max(worst, abs(new - alpha[i]))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def train(rows: pa.Table) -> Model:
    """The model from rows (key, label, features as bytes of int32)."""
    rows = rows.sort_by([("key", "ascending"), ("features", "ascending")])
    texts = [np.frombuffer(v.as_buffer(), np.int32) for v in rows["features"]]
    positive = rows["label"].to_numpy() == 1
    held = np.arange(len(texts)) % 5 == 0
    keep = ~held
    if positive[keep].all() or not positive[keep].any() or not held.any():
        share = (positive.sum() + 1) / (len(texts) + 2)
        return constant(share)
    own = [t for t, k in zip(texts, keep, strict=True) if k]
    scale = log_count_ratios(own, positive[keep]).astype(np.float32)
    weights = dual_descent(own, positive[keep], scale)
    model = Model(weights, scale, 1.0, 0.0)
    at = np.concatenate(([0], np.cumsum([len(t) for t, h in zip(texts, held, strict=True) if h])))
    flat = np.concatenate([t for t, h in zip(texts, held, strict=True) if h])
    model.slope, model.intercept = platt(model.margins(flat, at), positive[held])
    return model


def features(sample: DataFrame) -> DataFrame:
    """(key, label, features) of the texts of a labelled sample."""

    def run(batches):
        for batch in batches:
            for low, high, feature, at in blocks(batch.column("text")):
                packed = [feature[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(low, high - low),
                        batch.column("label").slice(low, high - low),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["key", "label", "features"],
                )

    return sample.mapInArrow(run, "key long, label int, features binary")


def fit(docs: DataFrame, labels: DataFrame, label: str, excluded: Column, sample: int = SAMPLE) -> Model:
    ready(docs.sparkSession)
    return fitted(features(labelled_sample(docs, labels, label, excluded, sample)), train) or constant(0.5)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every text."""
    sent = ready(docs.sparkSession).sparkContext.broadcast(model)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for low, high, feature, at in blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(sent.value.scores(feature, at))],
                    names=["doc_id", "score"],
                )

    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def op1_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, "quality", held_out(F.col("doc_id"), 5, 0))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
