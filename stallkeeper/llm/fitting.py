"""Small numeric helpers of the two classifiers: bounded training rows and a logistic curve."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F


def held_out(doc_id, modulus: int, remainder: int):
    """True for rows whose labels must not be learned; a row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def training_labels(labels: DataFrame, label: str, modulus: int, remainder: int, rows: int) -> DataFrame:
    """(doc_id, y) of at most ``rows`` labelled documents outside the held-out fold, chosen by a hash of the id.

    A doc_id with several labels counts once, by its highest; rows with null are left out.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"), modulus, remainder))
    one = usable.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def one_text_each(rows: DataFrame) -> DataFrame:
    """(doc_id, text, y): of the rows that repeat a doc_id the one whose text has the smallest hash."""
    least = F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("least")
    return rows.groupBy("doc_id", "y").agg(least).select("doc_id", "least.text", "y")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Weights (the constant first) of a ridge logistic curve by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    keep = np.r_[0.0, np.full(a.shape[1] - 1, ridge)]
    for _ in range(steps):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(keep + 1e-9), a.T @ (y - p) - keep * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
