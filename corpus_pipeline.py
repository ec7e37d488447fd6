"""Corpus pipeline: quality, near duplicates, contamination, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept.

Null and empty texts are scored as such, hold no words, passages or secrets and no near copies, and are encoded as no ids.  Rows without doc_id are in no
near-duplicate group; rows that repeat a doc_id are judged by their own texts and leave or stay each.  An empty table gives empty tables, and
further columns are carried through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stallkeeper.llm import decontaminate, jaccard_join, lattice, quality, secret_scan
from stallkeeper.llm.common import bounded_batches, table
from stallkeeper.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    bounded_batches(spark)
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blotted out in the texts."""
    return secret_scan.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip)."""
    return lattice.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", distinct_documents),
    ("benchmark decontamination", uncontaminated),
    ("secret scans", without_secrets),
    ("SentencePiece encoding", encoded),
]

#: A fitted classifier comes first, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stage(docs, "pipeline")
    return docs
