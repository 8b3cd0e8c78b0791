"""What the two text classifiers share: the labelled sample, calibration, one fitting task."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.sources.scratch import written

#: As many labels, three numbers each, are sent to all executors; more are shuffled with the texts.
SENT = 1 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, excluded: Column, bound: int | None = None) -> DataFrame:
    """(key, label, lang, text) of all labelled texts, or of `bound` at most, chosen by a hash of the id.

    `excluded` is over the doc_id of `labels`. An id labelled more than once takes
    its smallest label; of documents that share an id, the one with the smallest hash is
    used, so that a bound holds for rows.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~excluded)
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .withColumn("key", F.xxhash64("doc_id"))
        .withColumnRenamed("doc_id", "labelled_id")
    )
    if bound is None:
        small = written(chosen)
        small = F.broadcast(small) if small.count() <= SENT else small
    else:
        # At most `bound` rows of three numbers.
        small = F.broadcast(chosen.orderBy("key", "labelled_id").limit(bound))
    lang = F.col("lang") if "lang" in docs.columns else F.lit("")
    texts = docs.select(
        "doc_id",
        F.coalesce(lang.cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    joined = texts.join(small, texts.doc_id == small.labelled_id)
    # Combined before the shuffle, however many rows an id has.
    first = F.min(F.struct(F.xxhash64("text", "lang"), "lang", "text")).alias("row")
    return joined.groupBy("labelled_id", "key", "label").agg(first).select("key", "label", "row.lang", "row.text")


def fitted(examples: DataFrame, train: Callable[[pa.Table], object]) -> object:
    """`train` on all rows of a bounded DataFrame, in one task; the model comes back."""

    def run(batches):
        rows = list(batches)
        if rows:
            model = train(pa.Table.from_batches(rows))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = examples.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else None


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, positive: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """(slope, intercept) of P(positive | margin), with smoothed targets."""
    good, bad = float(positive.sum()), float((~positive).sum())
    if not good or not bad:
        return 0.0, float(np.log((good + 1) / (bad + 1)))
    target = np.where(positive, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.array([1.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - target * z) + 1e-4 * w[0] ** 2)

    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - target) + np.array([2e-4 * w[0], 0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag([2e-4, 1e-9])
        step = np.linalg.solve(curve + 1e-9 * np.eye(2), gradient)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])
