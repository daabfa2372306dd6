"""Labelled rows for the trained operators: the held-out fold and a bounded,
hash-drawn sample of the rest."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, mod 5, is 0 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, sample: int) -> DataFrame:
    """(doc_id, text, label) of labelled rows outside the held-out fold, about
    ``sample`` at most: those whose doc_id hashes below a share of the range.
    A null label is none; of several labels of a doc_id the largest counts."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("label_id"),
                          (F.col(target).cast("int") != 0).cast("int").alias("label"))
            .where(F.col("label").isNotNull() & F.col("label_id").isNotNull() & ~held_out(F.col("label_id")))
            .groupBy("label_id").agg(F.max("label").alias("label")))
    n = rows.count()
    if n > sample:
        rows = rows.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    # about ``sample`` rows of 12 bytes at most, whatever the corpus: a broadcast,
    # so that no text is shuffled to find the labelled ones
    return shared.id_text(docs).join(F.broadcast(rows), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label")


def hash_order(doc_id: int) -> tuple[int, int]:
    """The order in which labelled documents are taken."""
    return zlib.crc32(b"order%d" % doc_id), doc_id


def within_budget(rows: DataFrame, size: Column, budget: int) -> DataFrame:
    """The rows (doc_id, ...) of the documents that fit into ``budget``, in
    hash order: a document whose rows together do not fit is left out, whole.
    ``rows`` is a written table of a bounded number of doc_ids."""
    sizes = rows.groupBy("doc_id").agg(F.sum(size).alias("n")).collect()
    if sum(r.n for r in sizes) <= budget:
        return rows
    taken = []
    for r in sorted(sizes, key=lambda r: hash_order(r.doc_id)):
        if r.n <= budget:
            taken.append((r.doc_id,))
            budget -= r.n
    ids = rows.sparkSession.createDataFrame(taken, "doc_id long")
    return rows.join(F.broadcast(ids), "doc_id", "left_semi")
