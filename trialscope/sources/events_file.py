"""Reading a written event table back (CSV or JSON lines).

The CSV reader checks the header for the fourteen event columns, optionally
treats pandas' default missing-value tokens as null (so a file written by a
pandas job reads the same way), and casts to the declared types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..schemas import EVENT_COLUMNS, EVENTS, require_columns
from .csv_records import read_csv_records

def _typed(df: DataFrame) -> DataFrame:
    out = []
    for f in EVENTS.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegerType):
            # an int column with nulls is written by pandas as 1234.0; any
            # other text fails, with the value in the message
            whole = F.trim(c)
            c = F.when(whole.rlike(r"^[+-]?[0-9]+(\.0*)?$"),
                       F.regexp_replace(whole, r"\.0*$", "").cast("int")).when(
                c.isNotNull(), F.raise_error(F.concat(F.lit(f"{f.name} is no integer: "), c)).cast("int"))
        elif isinstance(f.dataType, T.DateType):
            c = F.to_date(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_events_csv(spark: SparkSession, path: str, pandas_nulls: bool = True) -> DataFrame:
    """Event table from CSV with a header row (RFC 4180 quoting, multi-line
    fields). Fails, naming the missing columns, if any is absent."""
    raw = read_csv_records(spark, path)  # all columns as text, in parallel
    require_columns(raw, EVENT_COLUMNS, "CSV")
    if pandas_nulls:
        tokens = list(C.PANDAS_NA_TOKENS)
        raw = raw.select(*[F.when(~F.col(c).isin(tokens), F.col(c)).alias(c)
                           for c in EVENT_COLUMNS])
    return _typed(raw)


def read_events_json(spark: SparkSession, path: str) -> DataFrame:
    """Event table from JSON lines, with the declared schema."""
    raw = spark.read.schema(T.StructType(
        [T.StructField(c, T.StringType()) for c in EVENT_COLUMNS])).json(path)
    return _typed(raw)


def read_events_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    require_columns(df, EVENT_COLUMNS, "parquet")
    return df.select(*EVENT_COLUMNS)
