"""Document quality by a regularised quadratic discriminant.

Each text becomes a vector of transformed statistics (lengths, shares of character classes, word variety, repetition).
Class means and covariances are fitted on at most ``fit_rows`` labelled documents; each covariance is shrunk towards the
pooled one and the pooled one towards its diagonal.  The score is the logistic of the difference of the two log densities,
from Mahalanobis distances by the cached Cholesky factors, on a curve fitted to the same rows.

Null and empty texts are scored like any other (all statistics zero).  Each row is scored by itself, so ties, repeated
rows and null ids (never held out) need no rule.  With fewer than two documents of a class the score is the smoothed share
of good documents.  Statistics are taken over whole texts, however long, one text at a time.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .fitting import held_out, logistic, one_text_each, sigmoid, training_labels

_OTHER, _LOWER, _UPPER, _DIGIT, _BLANK, _LINE, _STOP, _SIGN = range(8)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[ord("a"):ord("z") + 1] = _LOWER
_CLASS[ord("A"):ord("Z") + 1] = _UPPER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[[32, 9, 13]] = _BLANK
_CLASS[10] = _LINE
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
_CLASS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = _SIGN
_TABLE = _CLASS.tobytes()
N_STATISTICS = 14


def statistics(text: str) -> list[float]:
    data = text.encode()
    size = max(1, len(data))
    n = np.bincount(np.frombuffer(data.translate(_TABLE), np.uint8), minlength=8)
    words = text.split()
    k = max(1, len(words))
    kinds = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    runs = sum(map(str.__eq__, words, words[1:]))
    lines = text.split("\n")
    caps = sum(map(str.isupper, words))
    share = lambda x, y: np.log((x + 0.5) / (max(0, y - x) + 0.5 + 0.02 * y))
    return [
        np.log1p(len(words)), np.log1p(len(data) / k),
        share(n[_UPPER], size), share(n[_DIGIT], size), share(n[_SIGN], size), share(n[_STOP], size), share(n[_OTHER], size),
        share(caps, k), np.log(kinds + 1) - np.log(k + 1), np.log(pairs + 1) - np.log(k + 1), share(runs, k),
        share(len(lines) - len(set(lines)), len(lines)), np.log1p(len(lines)) - np.log1p(k),
        np.log1p(n[_STOP]) - np.log1p(k),
    ]


def _stats_udf(rows: DataFrame) -> DataFrame:
    """(doc_id, y, stats) of rows (doc_id, text, y)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got, pa.list_(pa.float64()))],
                                             ["doc_id", "y", "stats"])

    return rows.mapInArrow(run, "doc_id long, y int, stats array<double>")


def discriminant(x: np.ndarray, y: np.ndarray, shrink: float = 0.2, ridge: float = 0.05) -> dict:
    """Means, Cholesky factors of the shrunk covariances, and the curve over the log-density difference."""
    centre, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - centre) / scale, -6, 6)
    pooled = sum((y == c).sum() * np.cov(z[y == c].T, bias=True) for c in (0, 1)) / len(y)
    pooled = (1 - ridge) * pooled + ridge * (np.diag(np.diag(pooled)) + 0.1 * np.eye(len(pooled)))
    model = {"centre": centre, "scale": scale, "classes": []}
    for c in (0, 1):
        own = z[y == c]
        cov = (1 - shrink) * np.cov(own.T, bias=True) + shrink * pooled
        factor = np.linalg.cholesky(cov)
        model["classes"].append((own.mean(0), np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()))
    d = log_density_difference(model, x)
    model["curve"] = logistic(np.column_stack([d, np.arcsinh(d)]), y, ridge=1e-3)
    return model


def log_density_difference(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model["centre"]) / model["scale"], -6, 6)
    low, high = (-0.5 * (((z - mean) @ inverse.T) ** 2).sum(1) - 0.5 * log_det for mean, inverse, log_det in model["classes"])
    return high - low


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, fit_rows: int = 20_000) -> dict:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(training_labels(labels, "quality", modulus, remainder, fit_rows)), "doc_id")  # at most fit_rows rows
    got = _stats_udf(one_text_each(rows)).select("y", "stats").collect()  # bounded by fit_rows
    y = np.array([r.y for r in got], int)
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return {"share": (y.sum() + 0.5) / (len(y) + 1)}
    return discriminant(np.array([r.stats for r in got], float), y)


def quality_scores(docs: DataFrame, model: dict, threshold: float = 0.5, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of whole texts."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    scored = slim.mapInArrow(_scorer(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_texts(model: dict, texts: list[str]) -> np.ndarray:
    if "share" in model:
        return np.full(len(texts), float(model["share"]))
    x = np.array([statistics(t) for t in texts], float).reshape(-1, N_STATISTICS)
    d, w = log_density_difference(model, x), model["curve"]
    return sigmoid(w[0] + w[1] * d + w[2] * np.arcsinh(d))


def _scorer(model: dict):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = score_texts(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc_id", "score"])

    return score


def accepted(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """The documents, all their columns, that score at least ``threshold``."""
    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        return pd.Series(score_texts(model, texts.fillna("").tolist()))

    return docs.filter(score("text") >= threshold)
