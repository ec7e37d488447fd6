"""Very long texts: what stands at their ends is found, and places are right."""

import random

import numpy as np
import pytest

from stallkeeper.llm import chunk_dedup, decontaminate, jaccard_join, quality, secret_scan, toxicity

RNG = random.Random(17)
WORDS = [f"{a}{b}" for a in ("lor", "ban", "tik", "mesu", "ora") for b in ("a", "en", "ist", "om", "ul", "ek", "ira")]
LONG = " ".join(RNG.choices(WORDS, k=200_000))  # about 1 MB
PASSAGE = " ".join(f"p{k}" for k in range(60))


def test_a_benchmark_passage_at_the_end(spark, documents):
    docs = documents([(1, f"{LONG} {PASSAGE}"), (2, LONG), (3, PASSAGE)])
    bench = spark.createDataFrame([("b", PASSAGE)], "item_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["contaminated"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (200_060, 60, False), 2: (200_000, 0, False), 3: (60, 60, True)}


def test_a_repeated_passage_at_the_end(documents):
    rows = chunk_dedup.repeated_passages(documents([(1, f"{LONG} {PASSAGE}"), (2, f"short start {PASSAGE}")])).collect()
    assert {(r["doc_id"], r["start"], r["end"], r["n_words"]) for r in rows} == {
        (1, len(LONG) + 1, len(LONG) + 1 + len(PASSAGE), 60), (2, 12, 12 + len(PASSAGE), 60)}


def test_secrets_at_the_end(documents):
    key = "AKIA" + "Q7Z2" * 4
    row = secret_scan.secret_report(documents([(1, f"{LONG} {key}")])).first()
    assert (row["n_access"], row["n_assign"], row["n_hex"]) == (1, 0, 0)
    assert f"access:{len(LONG) + 1}:{len(LONG) + 1 + len(key)}" in row["spans"]


def test_near_copies_of_a_long_text(documents):
    words = LONG.split()
    near, far = list(words), list(words)
    for at in RNG.sample(range(len(words)), 500):
        near[at] = f"n{at}"
    for at in RNG.sample(range(len(words)), 40_000):
        far[at] = f"f{at}"
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(documents([(1, LONG), (2, " ".join(near)), (3, " ".join(far))])).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("module,scores", [(toxicity, toxicity.toxicity_scores), (quality, quality.quality_scores)])
def test_scores_of_a_long_text(spark, documents, module, scores):
    rows = [(i, " ".join(RNG.choices(WORDS[:12] if i % 2 else WORDS[20:], k=40))) for i in range(200)] + [(900, LONG)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    got = {r["doc_id"]: r["score"] for r in scores(docs, module.fit(docs, labels)).select("doc_id", "score").collect()}
    assert len(got) == 201 and np.isfinite(got[900]) and 0 <= got[900] <= 1
