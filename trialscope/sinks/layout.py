"""Storage layouts that later reports profit from.

* `write_bucketed` / `read_bucketed`: the four tables as Spark tables bucketed
  by study id. Semi-joins, summaries and joins of the event table then work
  inside a bucket; no row of the tables with many rows per study is shuffled.
  The number of buckets grows with the largest table.
* `write_clustered`: studies sorted by the interleaved bits of their dates.
  The event window asks for any of three dates, which prunes nothing in files
  sorted by another key (or by one of the dates only); here every row group
  covers a small range of all three, so the parquet reader skips most of them.

Both move every whole row to its file. A large table is written in rounds, each
of which reads the input again and takes its share of the rows: beside the
table itself no more than a round's rows lie on disk, in shuffle files that go
when the round ends. The input must give the same rows each time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .. import schemas

KEY = "nct_id"
DAY_BITS = 16                          # 179 years
FIRST_DAY = _dt.date(1900, 1, 1)
PART_BYTES = 256 << 20                 # of rows in memory: what one task gets, sorts and writes
ROUND_BYTES = 32 << 30                 # of rows in memory: what is shuffled at a time
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

CODEC = "zstd"                         # long texts take two thirds of snappy's bytes


def row_bytes(tables: Iterable[DataFrame]) -> list[int]:
    """The widths of each table's rows, added up in one pass over it."""
    sizes = []
    for k, df in enumerate(tables):
        texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields
                 if isinstance(f.dataType, T.StringType | T.BinaryType)]
        width = reduce(lambda a, b: a + b, texts, F.lit(8 * len(df.columns)).cast("long"))
        sizes.append(df.agg(F.lit(k).alias("table"), F.sum(width).alias("bytes")))
    found = reduce(DataFrame.unionAll, sizes)
    with _shuffles_dropped(found.sparkSession):
        return [r["bytes"] or 0 for r in sorted(found.collect())]


def parts_for(sizes: Iterable[int], least: int) -> int:
    """How many parts to write tables of these sizes in: `least`, or so many
    that a part of the largest one has PART_BYTES on average."""
    return max(least, -(-max(sizes, default=0) // PART_BYTES))


def rounds_for(size: int) -> int:
    """In how many rounds to write a table of that size: what is shuffled at a
    time has ROUND_BYTES on average, however large the table."""
    return max(1, -(-size // ROUND_BYTES))


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a job go when it has ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def write_bucketed(tables: Mapping[str, DataFrame], prefix: str, buckets: int) -> str:
    """Write each table as `<prefix>_<table>`, bucketed and sorted by study id;
    one file a bucket. All tables share the number of buckets, which is
    `buckets` or, for large tables, what `parts_for` finds. A large table is
    written some of its buckets at a time (`rounds_for`)."""
    tables = dict(tables)
    sizes = row_bytes(tables.values())
    buckets = parts_for(sizes, buckets)
    for (name, df), size in zip(tables.items(), sizes):
        rounds = min(rounds_for(size), buckets)
        for r in range(rounds):
            # the bucket of a row, as Spark finds it
            some = df.where(F.pmod(F.hash(KEY), F.lit(buckets)) % rounds == r) if rounds > 1 else df
            with _shuffles_dropped(df.sparkSession):
                (some.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY)
                 .mode("append" if r else "overwrite").option("compression", CODEC).format("parquet")
                 .saveAsTable(f"{prefix}_{name}"))
    return prefix


def read_bucketed(spark: SparkSession, prefix: str) -> dict[str, DataFrame]:
    """The tables that `write_bucketed` wrote under `prefix`."""
    return {name: schemas.conform(spark.table(f"{prefix}_{name}"), schema) for name, schema in schemas.INPUTS.items()}


def interleaved(dates: Sequence[str] = C.DATE_COLUMNS, bits: int = DAY_BITS) -> Column:
    """One long whose bits are the dates' day numbers by turns, the highest
    bits first; a missing date counts as the first day."""
    if bits * len(dates) > 62:
        raise ValueError("the interleaved bits must fit in a long")
    since = lambda d: F.coalesce(F.datediff(F.col(d), F.lit(FIRST_DAY)), F.lit(0))
    day = lambda d: F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), since(d))).cast("long")
    parts = [F.shiftleft(F.shiftright(day(d), b).bitwiseAND(1), b * len(dates) + k)
             for k, d in enumerate(dates) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_clustered(studies: DataFrame, path: str, files: int, dates: Sequence[str] = C.DATE_COLUMNS,
                    mode: str = "overwrite") -> str:
    """Studies as parquet, range-partitioned and sorted by `interleaved`, in
    `files` files or, for large tables, what `parts_for` finds. A missing date
    counts as the nearest other one of its row: such a row lies among those
    with similar dates, where it widens no file's ranges. A large table is
    written one range after the other (`rounds_for`)."""
    nearest = [sorted(range(len(dates)), key=lambda j, k=k: abs(j - k)) for k in range(len(dates))]
    filled = {f"__{d}": F.coalesce(*[F.col(dates[j]) for j in near]) for d, near in zip(dates, nearest)}
    placed = studies.withColumns(filled).withColumn("__place", interleaved(list(filled))).drop(*filled)
    size, = row_bytes([studies])
    files = parts_for([size], files)
    # an "ignore" cannot be told from a first round
    rounds = min(rounds_for(size), files) if mode != "ignore" else 1
    cuts = []
    if rounds > 1:
        shares = [k / rounds for k in range(1, rounds)]
        with _shuffles_dropped(studies.sparkSession):
            cuts = sorted(set(placed.agg(F.percentile_approx("__place", shares)).first()[0]))
    for k, (low, end) in enumerate(zip([None, *cuts], [*cuts, None])):
        some = placed if low is None else placed.where(F.col("__place") >= low)
        some = some if end is None else some.where(F.col("__place") < end)
        with _shuffles_dropped(studies.sparkSession):
            (some.repartitionByRange(-(-files // (len(cuts) + 1)), "__place").sortWithinPartitions("__place")
             .drop("__place").write.mode("append" if k else mode).option("compression", CODEC).parquet(path))
    return path
