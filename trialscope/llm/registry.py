"""Registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (centroids, exact_dedup, licenses, merkle, oracles, packing, quality_gam, quality_rules,
               sentence_pieces, shared, simhash, superminhash, token_counts, token_files, toxicity)

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared.on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECES)
    return sentence_pieces.decode(sentence_pieces.encode(_docs(spark, sf_dir), model), model)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(_docs(spark, sf_dir), public_tokenizers.path(BYTE_BPE), special=True)
    return token_counts.token_counts(token_counts.length_histogram(lengths))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_notices(_docs(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, sf_dir), public_tokenizers.path(BYTE_BPE), special=True)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_docs(spark, sf_dir), _labels(spark, sf_dir))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_docs(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_docs(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_docs(spark, sf_dir), _labels(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.quality(_docs(spark, sf_dir), _labels(spark, sf_dir))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op9(spark, _docs(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared.on_workers(spark)
    return centroids.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_proofs(_docs(spark, sf_dir))


def op13_superminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(_docs(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_sentence_pieces": op1_sentence_pieces,
        "op2_token_counts": op2_token_counts,
        "op3_license_scan": op3_license_scan,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_toxicity": op5_toxicity,
        "op6_simhash_near_dedup": op6_simhash_near_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_token_files": op9_token_files,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_centroid_clusters": op11_centroid_clusters,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_superminhash_near_dedup": op13_superminhash_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    out = {
        "op3_license_scan": oracles.license_notices(licenses.TEMPLATES, licenses.LEAST),
        "op10_exact_dedup": oracles.EXACT_DUPLICATES,
        "op11_centroid_clusters": oracles.centroid_clusters(centroids.CENTROIDS, centroids.ROUNDS, centroids.SALT),
        "op12_merkle_manifest": oracles.merkle_manifest(merkle.FAN),
        "op13_superminhash_near_dedup": oracles.shingle_duplicates(superminhash.LEAST),
    }
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
