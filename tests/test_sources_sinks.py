"""Readers and writers: CSV fidelity, null tokens, column checks, JSON, parquet."""

import datetime as dt
import os

import pandas as pd
import pytest

from trialscope import operators as O
from trialscope import schemas
from trialscope.sinks import write_csv, write_events_csv, write_json, write_parquet, write_unless_empty
from trialscope.sources import read_events_csv, read_events_json, read_events_parquet, read_tables

from . import golden as G

TRICKY = ['comma, inside', 'quote " inside', 'line\nbreak', '  leading and trailing  ', 'ünïcødé ·',
          'crlf\r\ninside', 'cr\ronly', 'tab\tinside', 'emoji \U0001F600 and \U0001D518',
          'trailing newline\n', '\nleading newline']


def _events(spark, titles):
    rows = []
    for i, title in enumerate(titles):
        rows.append((dt.date(2025, 1, 1 + i), "START", "ESTIMATED", f"N{i:02d}", title, "Phase 1",
                     "RECRUITING", None if i % 2 else 1234567, "ACTUAL", "Acme", "DRUG", "x · y",
                     "a, b", dt.date(2024, 1, 1)))
    return spark.createDataFrame(rows, schemas.EVENTS)


def test_events_csv_round_trip_keeps_text(spark, scratch):
    ev = _events(spark, TRICKY)
    path = write_events_csv(ev, os.path.join(scratch, "ev"))
    back = read_events_csv(spark, path)
    assert back.schema == schemas.EVENTS
    assert sorted(back.collect()) == sorted(ev.collect())


def test_events_csv_is_readable_by_pandas_in_order(spark, scratch):
    ev = _events(spark, TRICKY)
    path = write_events_csv(ev, os.path.join(scratch, "ev"), single_file=True)
    part = [f for f in os.listdir(path) if f.startswith("part-") and f.endswith(".csv")][0]
    pdf = pd.read_csv(os.path.join(path, part), keep_default_na=False)
    assert list(pdf.columns) == list(schemas.EVENT_COLUMNS)
    assert list(pdf["title"]) == TRICKY
    assert list(pdf["nct_id"]) == [f"N{i:02d}" for i in range(len(TRICKY))]


def test_pandas_null_tokens(spark, scratch):
    ev = _events(spark, ["NA", "None", "null", "real"])
    path = write_events_csv(ev, os.path.join(scratch, "ev"))
    back = {r.nct_id: r.title for r in read_events_csv(spark, path).collect()}
    assert back == {"N00": None, "N01": None, "N02": None, "N03": "real"}
    keep = {r.nct_id: r.title for r in read_events_csv(spark, path, pandas_nulls=False).collect()}
    assert keep["N00"] == "NA"


def test_pandas_written_csv_with_float_enrollment(spark, scratch):
    pdf = pd.DataFrame({c: ["x"] for c in schemas.EVENT_COLUMNS})
    pdf["event_date"] = ["2025-01-01"]
    pdf["last_update_posted_date"] = ["2024-01-01"]
    pdf["enrollment"] = [1234.0]
    path = os.path.join(scratch, "p.csv")
    pdf.to_csv(path, index=False)
    row = read_events_csv(spark, path).first()
    assert row.enrollment == 1234 and row.event_date == dt.date(2025, 1, 1)


@pytest.mark.parametrize("bad", ["1_2", "abc", "12.9", "99999999999"])
def test_a_bad_enrollment_fails(spark, scratch, bad):
    pdf = pd.DataFrame({c: ["x"] for c in schemas.EVENT_COLUMNS})
    pdf["event_date"] = pdf["last_update_posted_date"] = ["2025-01-01"]
    pdf["enrollment"] = [bad]
    path = os.path.join(scratch, "p.csv")
    pdf.to_csv(path, index=False)
    with pytest.raises(Exception, match=bad):
        read_events_csv(spark, path).collect()


def test_read_tables_named_by_format(spark, scratch):
    for name, df in G.tables(spark).items():
        df.write.parquet(os.path.join(scratch, name + ".parquet"))
    assert read_tables(spark, scratch)["studies"].count() == G.tables(spark)["studies"].count()


def test_command_line_run_on_csv(spark, scratch):
    from trialscope.__main__ import main
    root = os.path.join(scratch, "in")
    for name, df in G.tables(spark).items():
        write_csv(df, os.path.join(root, name))
    args = ["--tables", root, "--format", "csv", "--asof", "2024-11-30", "--table-months", "3", "--out"]
    out = main([*args, os.path.join(scratch, "out")], spark=spark)
    assert read_events_parquet(spark, out["events_parquet"]).count() == len(G.EVENTS)
    out = main([*args, os.path.join(scratch, "one"), "--sponsor-request", '{"sponsor": "Acme"}'], spark=spark)
    top = spark.read.option("header", True).csv(out["top_sponsor_phase"])
    assert {r.sponsor for r in top.collect()} == {"Acme"}


def test_run_sql_leaves_views_alone(spark):
    from trialscope.sources import run_sql
    spark.range(3).createOrReplaceTempView("studies")
    assert run_sql(spark, G.tables(spark), "SELECT count(*) AS n FROM {studies}").first().n > 3
    assert spark.table("studies").count() == 3
    spark.catalog.dropTempView("studies")


def test_missing_columns_are_named(spark, scratch):
    pdf = pd.DataFrame({"event_date": ["2025-01-01"], "nct_id": ["N1"]})
    path = os.path.join(scratch, "bad.csv")
    pdf.to_csv(path, index=False)
    with pytest.raises(ValueError, match=r"\['conditions', 'enrollment'"):
        read_events_csv(spark, path)


def test_json_and_parquet_round_trips(spark, scratch):
    ev = _events(spark, TRICKY)
    back = read_events_json(spark, write_json(ev, os.path.join(scratch, "j")))
    assert sorted(back.collect()) == sorted(ev.collect())
    back = read_events_parquet(spark, write_parquet(ev, os.path.join(scratch, "p")))
    assert sorted(back.collect()) == sorted(ev.collect())
    text = "".join(open(os.path.join(scratch, "j", f)).read()
                   for f in os.listdir(os.path.join(scratch, "j")) if f.endswith(".json"))
    assert '"enrollment":null' in text  # nulls are written, not dropped


def test_write_unless_empty(spark, scratch):
    empty = spark.createDataFrame([], "a int")
    assert write_unless_empty(empty, write_csv, os.path.join(scratch, "e")) is None
    assert not os.path.exists(os.path.join(scratch, "e"))
    full = spark.createDataFrame([(1,)], "a int")
    assert write_unless_empty(full, write_csv, os.path.join(scratch, "f")) is not None


def test_read_tables_from_files(spark, scratch):
    t = G.tables(spark)
    for name, df in t.items():
        df.write.parquet(os.path.join(scratch, name))
    back = read_tables(spark, scratch)
    assert back["studies"].schema == schemas.STUDIES
    ev = O.upcoming_events(back["studies"], back["sponsors"], back["interventions"],
                           back["conditions"], G.ASOF, 3)
    assert ev.count() == len(G.EVENTS)


def test_command_line_run(spark, scratch):
    from trialscope.__main__ import main
    root = os.path.join(scratch, "in")
    for name, df in G.tables(spark).items():
        df.write.parquet(os.path.join(root, name))
    out = main(["--tables", root, "--out", os.path.join(scratch, "out"), "--asof", "2024-11-30",
                "--table-months", "3", "--bars-months", "1"], spark=spark)
    ev = read_events_parquet(spark, out["events_parquet"])
    assert ev.count() == len(G.EVENTS)
    assert out["bars_primary_completion_date"] is None


def test_spread_only_under_split_sources(spark):
    from trialscope.sources import spread
    one = spark.range(1000).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(1000).repartition(6)
    assert spread(many, 4) is many
