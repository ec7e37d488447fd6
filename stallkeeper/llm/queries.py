"""Registered queries of the operators; each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chunk_dedup, decontaminate, embedding_dedup, jaccard_join, lattice, packing, pivot_clusters, prefix_trie, quality
from . import secret_scan, token_count, token_files, toxicity
from . import oracle
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("version")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each repeated passage of a document."""
    return chunk_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("version")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = token_files.token_file_index(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_classes(table(spark, sf_dir, "embeddings"))


def op11_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_clusters.cluster(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_quality": op4_quality,
        "op5_secret_scan": op5_secret_scan,
        "op6_token_counts": op6_token_counts,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_token_files": op8_token_files,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_pivot_clusters": op11_pivot_clusters,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_best_fit_packing": op13_best_fit_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": oracle.CONTAMINATION,
        "op11_pivot_clusters": oracle.CLUSTERS,
        "op12_prefix_trie": oracle.TRIE,
    }
