"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding takes compatibility and accented forms, Greek and Cyrillic look-alikes and digits written for letters back to
plain letters; everything else parts words.  The lexicon (word beginnings and whole words) and its weights, the exception
phrases and the length-normalised curve are learned from at most ``fit_rows`` labelled documents.  An exception is
a two-word phrase round a lexicon word that clean documents use and toxic ones do not; being the longer match it takes
the word's place and scores nothing.

Null and empty texts have no hits and get the score of a text without words.  Each row is scored by itself, so
ties, repeated rows and null ids (never held out) need no rule.  Without any usable label, or with labels of one class
only, the score is the smoothed share of that class for all.  Whole texts are matched, however long; the curve goes by their length.  Other columns
are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .fitting import held_out, logistic, one_text_each, sigmoid, training_labels

# fixed values: look-alikes of Latin letters in Cyrillic and Greek, and digits and signs that stand for letters
LOOK_ALIKES = dict(zip("авеѕіјкмнорстухԁɡӏαβεικνορτυχ", "abesijkmhopctyxdglabeiknoptux", strict=True))
DIGITS = dict(zip("0134578@$", "oieastbas", strict=True))

PREFIXES = (4, 5, 6, 7)


class _Folds(dict):
    """Translation table, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        out = []
        for c in unicodedata.normalize("NFKD", chr(code)).casefold():
            c = LOOK_ALIKES.get(c, DIGITS.get(c, c))
            if c.isalpha():
                out.append(c)
            elif not unicodedata.combining(c):
                out.append(" ")
        self[code] = "".join(out)
        return self[code]


_FOLDS = _Folds()


def folded_words(text: str) -> list[str]:
    return text.translate(_FOLDS).split()


def _terms(word: str) -> list[str]:
    """Lexicon terms a word may match: its beginnings, and itself with an end mark."""
    return [" " + word[:k] for k in PREFIXES if len(word) >= k] + ([f" {word} "] if len(word) >= 3 else [])


def _automaton(weights: dict[str, float], exceptions: Iterable[str]):
    import ahocorasick

    auto = ahocorasick.Automaton()
    for term, w in weights.items():
        auto.add_word(term, (w, len(term)))
    for phrase in exceptions:
        auto.add_word(phrase, (0.0, len(phrase)))
    auto.make_automaton()
    return auto


def _measure(auto, text: str) -> tuple[float, float, int]:
    """(weight of the hits, hits, words) of a text; each word counts once, by its longest match."""
    words = folded_words(text)
    total, hits = 0.0, 0
    if words and len(auto):
        for _, (w, _) in auto.iter_long(" " + "  ".join(words) + " "):
            total += w
            hits += w > 0
    return total, hits, len(words)


def _features(weight, hits, words) -> np.ndarray:
    weight, hits, words = (np.asarray(v, float) for v in (weight, hits, words))
    return np.column_stack([np.log1p(weight), np.log1p(hits), np.log1p(100 * hits / np.maximum(words, 1)),
                            np.minimum(hits, 2), (hits > 0) * np.log1p(words)])


def _counts(rows: DataFrame, emit) -> DataFrame:
    """(term, pos, neg): documents of each class with a term, summed per batch before the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y].update(emit(text))
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()),
                                              pa.array([seen[0][t] for t in terms], pa.int64())], ["term", "pos", "neg"])

    part = rows.select("text", "y").mapInArrow(count, "term string, pos long, neg long")
    return part.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _log_odds(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    return float(np.log((pos + 0.5) / (n_pos - pos + 0.5)) - np.log((neg + 0.5) / (n_neg - neg + 0.5)))


def learn_lexicon(rows: DataFrame, n_pos: int, n_neg: int, size: int = 3000) -> dict[str, float]:
    """Up to ``size`` terms by significance; a longer term stays only if it says much more than its beginning."""
    if not n_pos or not n_neg:
        return {}
    counted = _counts(rows, lambda t: {x for w in set(folded_words(t)) for x in _terms(w)})
    a, b = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(a / (n_pos - F.col("pos") + 0.5)) - F.log(b / (n_neg - F.col("neg") + 0.5))
    z = odds / F.sqrt(1 / a + 1 / b)
    found = counted.filter("pos >= 3").withColumn("odds", odds).withColumn("z", z).filter("odds > 1.5 and z > 2.8")
    kept: dict[str, float] = {}
    for r in sorted(found.orderBy(F.desc("z"), "term").limit(size).collect(), key=lambda r: (len(r.term), r.term)):
        stems = [kept[r.term[:k + 1]] for k in PREFIXES if k + 1 < len(r.term) and r.term[:k + 1] in kept]
        if not stems or r.odds > 1.5 * max(stems):
            kept[r.term] = r.odds
    return kept


def learn_exceptions(rows: DataFrame, lexicon: dict[str, float], n_pos: int, n_neg: int, size: int = 1000) -> list[str]:
    """Two-word phrases with a lexicon word, used by clean documents only."""
    if not lexicon:
        return []

    def phrases(text: str) -> set[str]:
        words, found = folded_words(text), set()
        for i, w in enumerate(words):
            if any(t in lexicon for t in _terms(w)):
                found.update(f" {words[k]}  {words[k + 1]} " for k in (i - 1, i) if 0 <= k < len(words) - 1)
        return found

    share = n_pos / max(1, n_neg)
    clean = _counts(rows, phrases).filter((F.col("neg") >= 3) & (F.col("pos") <= 0.1 * share * F.col("neg")))
    return [r.term for r in clean.orderBy(F.desc("neg"), "term").limit(size).collect()]


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, fit_rows: int = 20_000) -> dict:
    joined = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(training_labels(labels, "toxic", modulus, remainder, fit_rows)), "doc_id")
    rows = stage(one_text_each(joined).select("text", "y"), "toxic-rows")
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    lexicon = learn_lexicon(rows, n_pos, n_neg)
    exceptions = learn_exceptions(rows, lexicon, n_pos, n_neg)
    model = {"lexicon": lexicon, "exceptions": exceptions, "curve": None, "share": (n_pos + 0.5) / (n_pos + n_neg + 1)}
    if n_pos and n_neg:
        got = np.array([tuple(r) for r in _measured(rows.select(F.lit(0).cast("bigint"), "text", "y"), model).select(
            "weight", "hits", "words", "y").collect()], float)
        model["curve"] = logistic(_features(*got[:, :3].T), got[:, 3]).tolist()
    return model


def _measured(rows: DataFrame, model: dict) -> DataFrame:
    """(doc_id, y, weight, hits, words) of rows (doc_id, text, y)."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(model["lexicon"], model["exceptions"])
        for batch in batches:
            got = [_measure(auto, t) for t in batch.column(1).to_pylist()]
            cols = list(zip(*got, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(cols[0], pa.float64()), pa.array(
                cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["doc_id", "y", "weight", "hits", "words"])

    return rows.mapInArrow(measure, "doc_id long, y int, weight double, hits long, words long")


def toxicity_scores(docs: DataFrame, model: dict, threshold: float = 0.3, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits, words) of whole texts."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    curve, share = model["curve"], model["share"]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(model["lexicon"], model["exceptions"])
        for batch in batches:
            got = np.array([_measure(auto, t) for t in batch.column(1).to_pylist()], float).reshape(-1, 3)
            p = sigmoid(curve[0] + _features(*got.T) @ np.array(curve[1:])) if curve else np.full(len(got), share)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(got[:, 1].astype(np.int64)), pa.array(
                got[:, 2].astype(np.int64))], ["doc_id", "score", "hits", "words"])

    scored = slim.mapInArrow(score, "doc_id long, score double, hits long, words long")
    return scored.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "hits", "words")
