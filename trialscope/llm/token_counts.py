"""Operator 2: exact length histogram of the encoded documents.

Documents are aggregated by encoded length; suffix sums over the lengths then
answer, for every context limit, how many documents are longer, what all
documents hold when cut there, and where the quantiles lie. A limit between two
lengths is answered from the longest length below it.

Defined results: a null or empty text has length 0; repeated rows count as
often as they stand; an empty table gives an empty histogram and no answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .tokens import encoder

LIMITS = (512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 131072)
QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)
SPAN = 1024  # lengths of one block; suffix sums run inside a block, then over blocks


def _lengths(tokenizer: str, special: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.text_slices(batches):
            offsets, _ = encoder(tokenizer, special).encode(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets))],
                                             names=["doc_id", "n_tokens"])
    return run


def encoded_lengths(docs: DataFrame, tokenizer: str, special: bool = False) -> DataFrame:
    """(doc_id, n_tokens) of every row."""
    return shared.id_text(docs).mapInArrow(_lengths(tokenizer, special), "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs)."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """A row for every length L that occurs, taken as a context limit:

    n_docs (of this length), docs_longer, tokens_longer (their whole tokens),
    total_tokens and total_docs (of the table), truncated_total (all documents
    cut at L), quantile (the share of documents of at most L tokens).
    """
    block = F.floor(F.col("n_tokens") / SPAN)
    # used twice below: written once, so that texts are encoded once
    h = shared.stored(histogram, "lengths").withColumn("block", block).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    # one row for 1024 lengths: as many as the longest document has thousands of tokens
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select("block", *(F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_after") for c in "dt"),
                           *(F.sum(c).over(every).alias(f"{c}_all") for c in "dt"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer = lambda c, s: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(s)
    return (h.join(blocks, "block")
            .withColumn("docs_longer", longer("n_docs", "d_after"))
            .withColumn("tokens_longer", longer("tokens", "t_after"))
            .select("n_tokens", "n_docs", "docs_longer", "tokens_longer",
                    F.col("d_all").alias("total_docs"), F.col("t_all").alias("total_tokens"),
                    (F.col("t_all") - F.col("tokens_longer")
                     + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_total"),
                    (1 - F.col("docs_longer") / F.col("d_all")).alias("quantile")))


def length_quantiles(limits: DataFrame, probabilities: list[float]) -> DataFrame:
    """(p, n_tokens): the least length that at least the share p does not exceed."""
    p = limits.sparkSession.createDataFrame([(float(x),) for x in probabilities], "p double")
    return (F.broadcast(p).join(limits, F.col("quantile") >= F.col("p") - 1e-12, "left")
            .groupBy("p").agg(F.min("n_tokens").alias("n_tokens")))


def at_limits(limits: DataFrame, wanted: list[int]) -> DataFrame:
    """The row that ``context_limits`` would have for each wanted limit, with
    n_docs 0 where no document has this length."""
    asked = limits.sparkSession.createDataFrame([(int(x),) for x in sorted(set(wanted))], "asked long")
    below = F.when(F.col("n_tokens") <= F.col("asked"), F.struct("n_tokens", "n_docs", "docs_longer", "tokens_longer"))
    found = (limits.crossJoin(F.broadcast(asked)).groupBy("asked")  # the limits are a short list
             .agg(F.max(below).alias("b"), F.max("total_docs").alias("total_docs"), F.max("total_tokens").alias("total_tokens")))
    found = found.select(F.col("asked").alias("n_tokens"),
                         F.when(F.col("b.n_tokens") == F.col("asked"), F.col("b.n_docs")).otherwise(0).alias("n_docs"),
                         F.coalesce("b.docs_longer", "total_docs").alias("docs_longer"),
                         F.coalesce("b.tokens_longer", "total_tokens").alias("tokens_longer"), "total_docs", "total_tokens")
    return found.select("*", (F.col("total_tokens") - F.col("tokens_longer")
                              + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_total"),
                        (1 - F.col("docs_longer") / F.col("total_docs")).alias("quantile"))


def token_counts(histogram: DataFrame, wanted: list[int] = LIMITS, probabilities: list[float] = QUANTILES) -> DataFrame:
    """The rows of ``context_limits`` with ``asked`` = 'length', those of the
    wanted limits ('limit'), and those of the lengths at the wanted quantiles
    ('quantile', with their ``p``)."""
    # used four times below: a row for each length, written once
    limits = shared.stored(context_limits(histogram), "limits")
    at = length_quantiles(limits, probabilities).join(limits, "n_tokens").select(*limits.columns, "p")
    none = F.lit(None).cast("double").alias("p")
    return (limits.select("*", none).withColumn("asked", F.lit("length"))
            .unionByName(at_limits(limits, wanted).select("*", none).withColumn("asked", F.lit("limit")))
            .unionByName(at.withColumn("asked", F.lit("quantile"))))
