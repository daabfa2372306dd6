"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``docs``, whatever they are. A stage filters by
whole rows: rows that share a doc_id are judged by their own texts. The trained
stages read ``labels`` beside the documents. Every stage takes null, empty and
very long texts, repeated rows, null doc_ids, no rows at all, and further
columns of any name, and says below what they give.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trialscope.llm import exact_dedup, packing, quality_gam, shared, simhash
from trialscope.llm import quality_rules as rules


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared.on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line labelling keep. A null or empty
    text has too few words and goes; repeated rows stay or go together."""
    return rules.keep_passing(docs, _labels(spark, sf_dir))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores as good. A null or empty text
    is scored as a text without words; repeated rows stay or go together."""
    return quality_gam.keep_good(docs, _labels(spark, sf_dir))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, white space aside: the one with
    the most code points, then the smallest doc_id. Null counts as empty, and
    empty texts are one group; of repeated rows one stays."""
    shared.on_workers(spark)
    return exact_dedup.keep_first(docs)


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, with the operator's own
    shingle length and bit distance: one that has the group's smallest doc_id.
    Texts without words are one group; of repeated rows one stays."""
    shared.on_workers(spark)
    return simhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces in sequences of at most 2048 tokens. A
    null or empty text is one piece, its end token; repeated rows are packed
    as often as they occur."""
    shared.on_workers(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), special=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("exact_duplicates", exact_duplicates),
    ("simhash_near_duplicates", simhash_near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

# Trained models and tokenizers have no SQL; tests hold every stage against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the
    shared folder, so a lost executor never reruns an earlier stage. A stage's
    table goes when the next one is written; the last one stays, as the
    result is read from it."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), ""
    for name, stage in STAGES[:-1]:
        docs, path = shared.replaced(stage(spark, docs, sf_dir), f"stage-{name}", path)
    return STAGES[-1][1](spark, docs, sf_dir)
