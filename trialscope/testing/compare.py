"""Spark result vs DuckDB oracle: row count, column names and types, and an
order-insensitive hash of the values (as the driver's correctness gate)."""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

import duckdb

from .fixture_views import TABLES as STAR_TABLES

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        except duckdb.Error:
            if t in STAR_TABLES:
                raise
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    return str(v)


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_canon(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


_SPARK_KIND = {"IntegerType": "int32", "LongType": "int64", "StringType": "str",
               "DateType": "date", "DoubleType": "float64"}
_DUCK_KIND = {"INTEGER": "int32", "BIGINT": "int64", "VARCHAR": "str", "DATE": "date",
              "DOUBLE": "float64"}


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_types = {f.name: _SPARK_KIND.get(type(f.dataType).__name__, type(f.dataType).__name__)
               for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: _DUCK_KIND.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    res = {
        "rows": (len(s_rows), len(d_rows)),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "types_match": s_types == d_types,
        "hash_match": digest(s_cols, s_rows) == digest(d_cols, d_rows),
    }
    res["ok"] = (res["rows"][0] == res["rows"][1] and res["columns_match"]
                 and res["hash_match"])
    if not res["columns_match"]:
        res["columns"] = (sorted(s_cols), sorted(d_cols))
    if not res["types_match"]:
        res["types"] = (s_types, d_types)
    return res
