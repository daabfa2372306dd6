"""Helpers shared by the operators: input columns, shared folders, batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Bytes of text that one Python step holds at a time (one longer text is a
# step of its own).
SLICE_BYTES = 4 << 20


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package when the session
    was started elsewhere; a cluster gets it with ``--py-files``."""
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [PACKAGE_ROOT, have]))


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string): only these two columns leave the scan, so
    extra columns of any name cannot clash; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may run without it: one folder is then made for the
    session. On a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="corpus-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path (not made yet) under the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def replaced(df: DataFrame, name: str, old: str = "") -> tuple[DataFrame, str]:
    """``stored``, with its path; then the table ``old``, from which ``df`` was
    made and which nobody else reads, is removed."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    if old:
        remove(spark, old)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, so a
    lost executor costs a reread and never another run of ``df``."""
    return replaced(df, name)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that its operator wrote and nobody reads any more."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def text_slices(batches: Iterator[pa.RecordBatch], max_bytes: int = SLICE_BYTES
                ) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches with a ``text`` column so that a slice has at most
    ``max_bytes`` of text, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        begin = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += int(n)
        yield batch.slice(begin)
        pa.default_memory_pool().release_unused()


def rows_marked(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose doc_id and text hash (``mark``,
    xxhash64) are in ``stay`` (doc_id, mark, rows: how many rows have both); of
    several, one. Texts are shuffled once and sorted only where rows repeat."""
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    key = ["__id", "__mark"]
    own = docs.select("*", name(F.col("doc_id")).alias("__id"), F.xxhash64(name(F.col("text"))).alias("__mark"))
    stay = stored(stay.groupBy(name(F.col("doc_id")).alias("__id"), F.col("mark").alias("__mark"))
                  .agg(F.sum("rows").alias("rows")), "stay")
    kept = own.join(stay.select(key).hint("shuffle_hash"), key, "left_semi")
    if not stay.where("rows > 1").isEmpty():
        kept = kept.dropDuplicates(key)
    return kept.select([F.col(f"`{c}`") for c in docs.columns])


def keep_rows(docs: DataFrame, judge: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` whose text passes, every column as it was.
    ``judge`` takes the texts (null as empty) and gives a boolean each."""
    marked = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                         F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            keep = pa.array(judge(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("row")], names=["row"]).filter(keep)

    kept = marked.mapInArrow(run, StructType([StructField("row", docs.schema)]))
    return kept.select("row.*")
