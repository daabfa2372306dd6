"""Writers: sorted CSV, JSON lines, parquet; skip-if-empty.

Large tables are written in parallel: a sorted write range-partitions the
rows, so part files are in order (part-00000 holds the first rows) and no
single task sees the whole table. `single_file=True` is for small reports
only (it funnels the result through one task).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.events import event_order_columns
from ..schemas import EVENT_COLUMNS

# Spark's CSV writer trims white space around values by default; text
# fields must survive a round trip unchanged.
CSV_WRITE_OPTIONS = {"header": "true", "escape": '"', "quote": '"',
                     "dateFormat": "yyyy-MM-dd", "nullValue": "",
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
FILE_ROWS = 1 << 17


def _maybe_single(df: DataFrame, single_file: bool) -> DataFrame:
    # a shuffle of the small result: the stage that makes it keeps its tasks
    return df.repartition(1) if single_file else df


def _ordered(df: DataFrame, order, single_file: bool) -> DataFrame:
    if not order:
        return _maybe_single(df, single_file)
    return df.repartition(1).sortWithinPartitions(*order) if single_file else df.orderBy(*order)


def landed(df: DataFrame) -> DataFrame:
    """A small report, of a known bound, as a local relation: computed once."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def write_csv(df: DataFrame, path: str, order=None, single_file: bool = False,
              mode: str = "overwrite", compression: str | None = None) -> str:
    """CSV with a header row, RFC 4180 quoting, null as an empty field. A
    compressed file is read by one task, so it gets FILE_ROWS rows at most."""
    packed = {"compression": compression, "maxRecordsPerFile": str(FILE_ROWS)} if compression else {}
    _ordered(df, order, single_file).write.mode(mode).options(**CSV_WRITE_OPTIONS, **packed).csv(path)
    return path


def write_events_csv(events: DataFrame, path: str, single_file: bool = False,
                     mode: str = "overwrite") -> str:
    """The event table in file column order and final row order."""
    return write_csv(events.select(*EVENT_COLUMNS), path, order=event_order_columns(),
                     single_file=single_file, mode=mode)


def write_json(df: DataFrame, path: str, order=None, single_file: bool = False,
               mode: str = "overwrite") -> str:
    """JSON lines, one object per row; nulls written as null (not dropped)."""
    (_ordered(df, order, single_file).write.mode(mode)
     .option("ignoreNullFields", "false").option("dateFormat", "yyyy-MM-dd").json(path))
    return path


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite",
                  compression: str | None = None) -> str:
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_unless_empty(df: DataFrame, write, path: str, *args, counted: Column | None = None, **kwargs) -> str | None:
    """`write(df, path, ...)` unless `df` has no rows (or none where `counted`
    holds): one pass writes and counts.

    The rows are written beside `path` and counted on the way; the result then
    takes the place of `path`, or is removed, and what was at `path` stays.
    Returns `path`, or None when skipped.
    """
    spark = df.sparkSession
    seen = Observation()
    rows = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    draft = f"{path.rstrip('/')}.draft-{uuid.uuid4().hex}"
    write(df.observe(seen, rows.alias("rows")), draft, *args, **kwargs)
    target, written = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, draft))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not seen.get.get("rows"):
        fs.delete(written, True)
        return None
    fs.delete(target, True)
    fs.rename(written, target)
    return path
