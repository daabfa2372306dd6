"""Readers for the four input tables: parquet / any file format, or JDBC.

Readers cast to the declared schema (text formats are read with it, nothing
is inferred) and return lazy DataFrames;
filters and column pruning of the later reports reach the scan (parquet
row-group skipping, or a WHERE clause sent to the database).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .csv_records import read_csv_records

TABLE_NAMES = tuple(schemas.INPUTS)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition a source that yields fewer partitions than
    the session's default parallelism (a file with one row group, a JDBC read
    without predicates), so the per-row work before the first shuffle runs on
    every core. A large source already has enough splits and is returned
    unchanged (no extra shuffle)."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if want <= 1 or df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


# With reader options of the caller (another delimiter, an encoding) CSV goes
# through Spark's source, which gives a file to one task.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST",
               "enforceSchema": "false"}


def _entry(spark: SparkSession, folder: str, name: str, fmt: str) -> str:
    """`<folder>/<name>`, or `<folder>/<name>.<fmt>` where only that is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return f"{folder}/{name}" if fs.exists(path) else f"{folder}/{name}.{fmt}"


def read_tables(spark: SparkSession, paths: str | Mapping[str, str],
                fmt: str = "parquet", options: Mapping[str, str] | None = None,
                snapshot: str | None = None, snapshot_column: str = "snapshot") -> dict[str, DataFrame]:
    """Read studies / sponsors / interventions / conditions.

    `paths` is a folder holding `<table>` (or `<table>.<fmt>`) entries, or a
    mapping table -> path. Columns beyond the declared ones are ignored;
    declared columns are cast to their declared types.

    With `snapshot`, each table is a folder partitioned by `snapshot_column`
    (e.g. `studies/snapshot=2024-11-30/`) and only that partition is read:
    the equality filter prunes the other snapshots at file listing.
    """
    out = {}
    for name in TABLE_NAMES if isinstance(paths, str) else paths:
        if isinstance(paths, str):
            path = _entry(spark, paths.rstrip("/"), name, fmt)
        else:
            path = paths[name]
        if fmt == "csv" and not options and snapshot is None:
            # a CSV registry: header row, RFC 4180 quotes, titles of several lines
            df = read_csv_records(spark, path, schemas.INPUTS[name])
        else:
            reader = spark.read.format(fmt).options(**{**(CSV_OPTIONS if fmt == "csv" else {}), **(options or {})})
            df = (reader if fmt == "parquet" else reader.schema(schemas.INPUTS[name])).load(path)
        if snapshot is not None:
            df = df.where(F.col(snapshot_column) == F.lit(snapshot))
        out[name] = schemas.conform(df, schemas.INPUTS[name])
    return out


def nct_id_predicates(bounds: Sequence[str], column: str = "nct_id") -> list[str]:
    """WHERE clauses that split a text key into len(bounds) + 1 disjoint
    ranges (plus a NULL range), one JDBC partition each.

    `bounds` must be ascending; e.g. ["NCT02", "NCT04"] gives
    nct_id < 'NCT02', 'NCT02' <= nct_id < 'NCT04', nct_id >= 'NCT04' and
    nct_id IS NULL. The ranges cover every row exactly once. Bounds hold
    digits and capital letters only: their order is the same in every
    database collation, so no two ranges overlap there.
    """
    if not all(re.fullmatch("[0-9A-Z]+", b) for b in bounds):
        raise ValueError("bounds may hold digits and capital letters only")
    if list(bounds) != sorted(bounds) or len(set(bounds)) != len(bounds):
        raise ValueError("bounds must be strictly ascending")

    def q(v: str) -> str:
        return "'" + v.replace("'", "''") + "'"

    preds, lo = [], None
    for b in bounds:
        preds.append(f"{column} < {q(b)}" if lo is None else f"{column} >= {q(lo)} AND {column} < {q(b)}")
        lo = b
    preds.append(f"{column} >= {q(lo)}" if lo is not None else f"{column} IS NOT NULL")
    preds.append(f"{column} IS NULL")
    return preds


def equi_depth_bounds(ids: DataFrame, parts: int, column: str = "nct_id", per_part: int = 256) -> list[str]:
    """Split points for `nct_id_predicates`, so that `parts` ranges hold about
    equally many rows of `ids`, however the ids are distributed.

    They are quantiles of a bottom-k sketch: the `parts * per_part` rows with
    the least hash of (id, row number), a uniform sample of the rows found by
    a per-task top-k. A split point is cut before the first character that is
    no digit or capital, and equal ones are one, so fewer may come back; an id
    with more rows than a range should have cannot be split.
    """
    k = parts * per_part
    draw = F.xxhash64(F.col(column), F.monotonically_increasing_id())
    rows = ids.where(F.col(column).isNotNull()).select(column).orderBy(draw).limit(k).collect()  # parts x per_part ids
    found = sorted(r[0] for r in rows)
    cuts = (re.match("[0-9A-Z]*", found[len(found) * i // parts]).group() for i in range(1, parts)) if found else ()
    return sorted({c for c in cuts if c})


def jdbc_bounds(spark: SparkSession, url: str, properties: Mapping[str, str], parts: int,
                schema_name: str | None = None, table: str = "studies") -> list[str]:
    """`equi_depth_bounds` of a database table; only the id column is asked for."""
    name = f"{schema_name}.{table}" if schema_name else table
    return equi_depth_bounds(spark.read.jdbc(url, name, properties=dict(properties)).select("nct_id"), parts)


def read_jdbc_tables(spark: SparkSession, url: str, properties: Mapping[str, str],
                     schema_name: str | None = None, bounds: Sequence[str] = (),
                     fetchsize: int = 10000, one_connection: bool = False) -> dict[str, DataFrame]:
    """Read the four tables over JDBC (e.g. PostgreSQL with sslmode=require
    in the URL; user / password in `properties`).

    With `bounds`, each table is read as len(bounds) + 2 parallel range
    queries on nct_id (a text key cannot be a numeric partition column).
    Spark pushes the reports' filters and column lists into each query.
    `jdbc_bounds` derives them. Without bounds a table is one task; that must
    be asked for with `one_connection`.
    """
    if not bounds and not one_connection:
        raise ValueError("give nct_id bounds for parallel reads, or one_connection=True for a small registry")
    props = {"fetchsize": str(fetchsize), **properties}
    preds = nct_id_predicates(bounds) if bounds else None
    out = {}
    for name in TABLE_NAMES:
        table = f"{schema_name}.{name}" if schema_name else name
        if preds:
            df = spark.read.jdbc(url, table, predicates=preds, properties=props)
        else:
            # one connection, one partition: spread the rows over the cores
            # before the reports' per-row work
            df = spread(spark.read.jdbc(url, table, properties=props))
        out[name] = schemas.conform(df, schemas.INPUTS[name])
    return out


def run_sql(spark: SparkSession, tables: Mapping[str, DataFrame], text: str, **args) -> DataFrame:
    """Ad-hoc SQL over the tables, named in the text as `{studies}` and so on;
    the caller's own views are left alone.

    Named parameters (`:name` in the text) are bound by Spark, not pasted into
    the text.
    """
    used = {name: tables[name] for name in tables if f"{{{name}}}" in text}
    return spark.sql(text, args=args or None, **used)
