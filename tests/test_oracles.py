"""Every registered query against its DuckDB oracle on the driver's data.

sf0.001 by default (fast); set TRIALSCOPE_ORACLE_SF=/root/testdata/sf0.01 for
the driver's own scale.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from trialscope.testing import registry
from trialscope.testing.compare import compare, duck

SF_DIR = os.environ.get("TRIALSCOPE_ORACLE_SF", "/root/testdata/sf0.001")
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(registry.queries()[key](spark, SF_DIR), con, registry.oracle_sql()[key])
    assert res["ok"], res
    assert res["types_match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 38  # FIXTURES.md §2: 38 events at sf0.001
    assert df.columns[0] == "event_date"


def test_round_sum_goes_past_the_end_of_a_long(spark):
    for values in ([2 ** 62] * 3, [2 ** 63 - 1, 1], [-2 ** 63, -1], [5, -7, None], [None], []):
        total = sum(v or 0 for v in values)
        want = (total + 2 ** 63) % 2 ** 64 - 2 ** 63 if any(v is not None for v in values) else None
        rows = spark.createDataFrame([(v,) for v in values], "v long")
        assert rows.agg(registry._round_sum(F.col("v"))).first()[0] == want, values


def test_tables_roundtrip_past_the_range_of_a_long(spark, scratch):
    """90,000 rows, whose hashes sum to more than a long holds. The SQL's own
    last cast would fail there: its sum is taken as it is before that cast."""
    lines = spark.range(90_000).selectExpr(
        "id % 3000 AS l_orderkey", "id % 40 AS l_partkey", "id % 30 AS l_suppkey", "CAST(id % 7 AS int) AS l_linenumber",
        "CAST(TIMESTAMP_NTZ'1998-01-01 00:00:00' + make_dt_interval(CAST(id % 400 AS int)) AS timestamp_ntz) AS l_shipdate")
    star = {
        "lineitem": lines,
        "orders": lines.where("l_linenumber < 3").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("o_orderdate")).selectExpr(
            "l_orderkey AS o_orderkey", "l_orderkey % 100 AS o_custkey", "CAST(l_orderkey AS double) AS o_totalprice", "o_orderdate"),
        "supplier": spark.range(30).selectExpr("id AS s_suppkey", "concat('Supplier ', id) AS s_name"),
        "part": spark.range(40).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "'brand' AS p_brand", "'type' AS p_type"),
        "documents": spark.range(50).selectExpr("id AS doc_id", "concat('title \"', id, '\"\\n', repeat('word, ', 20)) AS text"),
    }
    for name, df in star.items():
        df.coalesce(1).write.parquet(f"{scratch}/{name}.parquet")
    con = duckdb.connect()
    for name in star:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{scratch}/{name}.parquet/*.parquet')")
    sql = registry.oracle_sql()["tables_roundtrip"].replace("AS BIGINT) AS checksum", "AS HUGEINT) AS checksum")
    found = con.sql(sql).fetchall()
    assert sum(r[4] >= 2 ** 63 for r in found) == 3
    want = sorted((*r[:4], (r[4] + 2 ** 63) % 2 ** 64 - 2 ** 63) for r in found)
    assert sorted(map(tuple, registry.queries()["tables_roundtrip"](spark, scratch).collect())) == want
