"""What the two document classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import durable

#: Labelled rows that the toxicity classifier is fitted on, at most; taken by a hash of their id.
TRAIN_ROWS = 20_000


def crc(doc_id: Column) -> Column:
    """CRC-32 of an id as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most `rows` documents with their label (doc_id, text, label), written once.

    `learn` says of a label row (doc_id) whether it may be learned from. The sampled ids
    number at most `rows` and are broadcast, so only the sample's texts are shuffled, and it
    lies in many tasks. Of several texts under one id the smallest counts.
    """
    some = label_of(labels, label, learn).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return durable(_texts(docs, F.broadcast(some)), "sample")


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """All documents with their label (doc_id, text, label), as `labelled_sample` has some of them."""
    return _texts(docs, label_of(labels, label, learn))


def label_of(labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """doc_id and label of the ids that may be learned from, each once."""
    l = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))  # noqa: E741
    known = l.where(learn & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def _texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    texts = d.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return texts.select("doc_id", "text", "label")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one, of the
    constant, is not penalized."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
