"""Parallel multi-line CSV: the same rows as the whole-file reader, wherever
the file is cut."""

import csv
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from trialscope import schemas
from trialscope.sources import read_events_csv, read_tables
from trialscope.sources.csv_records import read_csv_records, records

from . import golden as G

ROWS = [
    ["a", "b", "c"],
    ["1", "plain", "x"],
    ["2", "two\nlines", "y"],
    ["3", 'quoted "word"', ""],
    ["4", 'ends with quote"', "\n"],
    ["5", "", "comma, and\r\nCRLF inside"],
    ["6", '"\n"', "many\n\n\nlines, \"\"\n"],
    ["7", "é 中 \U0001f600\n" * 5, " spaces kept "],
    ["8", "x" * 300 + "\n" + "y" * 300, "tail"],
]


def write(path, rows, end="\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end).writerows(rows)


@pytest.fixture()
def cut(spark):
    def set_bytes(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield set_bytes
    for k in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{k}")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_do_not_depend_on_the_cuts(spark, scratch, cut, end):
    path = f"{scratch}/t/one.csv"
    write(path, ROWS, end)
    size = os.path.getsize(path)
    want = sorted((r[0], r[1] or None, r[2] or None) for r in ROWS[1:])
    seen = set()
    # cuts at every byte of the file's beginning, then coarser
    for n in [*range(1, 60, 3), *range(60, size, 97), size, 10 * size]:
        cut(n)
        df = read_csv_records(spark, path)
        got = sorted(tuple(r) for r in df.collect())
        assert got == want, n
        seen.add(spark.read.text(path).rdd.getNumPartitions())
    assert 1 in seen and max(seen) > 100


def test_a_large_file_is_many_tasks_and_equals_the_whole_file_reader(spark, scratch, cut):
    path = f"{scratch}/t/large.csv"
    write(path, ROWS[:1] + [[str(k), *ROWS[1 + k % 8][1:]] for k in range(4000)])
    whole = spark.read.options(header="true", quote='"', escape='"', multiLine="true").csv(path)
    assert whole.rdd.getNumPartitions() == 1
    cut(os.path.getsize(path) // 20)
    df = read_csv_records(spark, path)
    assert df.exceptAll(whole).count() == 0 and whole.exceptAll(df).count() == 0
    plan = df._jdf.queryExecution().toString()
    assert "Scan text" in plan and "Scan csv" not in plan
    assert spark.read.text(path).rdd.getNumPartitions() >= 20


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f: os.path.getsize(f) for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def test_only_records_cut_by_a_block_are_shuffled(spark, scratch, cut):
    rng = random.Random(1)
    rows = [[str(k), "\n".join(rng.randbytes(400).hex() for _ in range(5)), "x"] for k in range(2000)]
    write(f"{scratch}/t/one.csv", ROWS[:1] + rows)
    size = os.path.getsize(f"{scratch}/t/one.csv")
    cut(size // 20)
    before = _shuffle_files(spark)
    got = read_csv_records(spark, f"{scratch}/t").agg(F.count("b"), F.sum(F.length("b"))).first()
    assert tuple(got) == (2000, sum(len(r[1]) for r in rows))
    moved = sum(n for f, n in _shuffle_files(spark).items() if f not in before)
    assert 0 < moved < 0.1 * size


def test_a_record_over_many_blocks_and_batches(spark, scratch, cut):
    rows = [["1", "\n".join(f"line {k}" for k in range(3000)), "x"], ["2", "", "y"], ["3", "\n" * 500, '"\n"'], ["4", "p", "z"]]
    write(f"{scratch}/t/one.csv", ROWS[:1] + rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for n in (700, 5000, 10 ** 6):
            cut(n)
            got = sorted(tuple(r) for r in read_csv_records(spark, f"{scratch}/t").collect())
            assert got == sorted((r[0], r[1] or None, r[2]) for r in rows), n
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_compressed_files_are_bounded_and_read_back(spark, scratch, monkeypatch):
    from trialscope.sinks import write_csv, writers
    monkeypatch.setattr(writers, "FILE_ROWS", 100)
    want = [(k, f'"{k}"\n,text ' * 50) for k in range(1000)]
    write_csv(spark.createDataFrame(want, "k int, t string").repartition(2), f"{scratch}/gz", compression="gzip")
    files = glob.glob(f"{scratch}/gz/*.csv.gz")
    assert 10 <= len(files) <= 12 and sum(map(os.path.getsize, files)) < 0.2 * sum(len(t) for _, t in want)
    back = read_csv_records(spark, f"{scratch}/gz", schemas._struct(("k", schemas._I), ("t", schemas._S)))
    assert sorted(map(tuple, back.collect())) == want


def test_several_files_each_with_a_header(spark, scratch, cut):
    for k in range(3):
        write(f"{scratch}/many/p{k}.csv", ROWS[:1] + [[f"{k}{r[0]}", *r[1:]] for r in ROWS[1:]])
    cut(50)
    df = read_csv_records(spark, f"{scratch}/many")
    assert df.count() == 3 * 8 and df.where("a = 'a'").count() == 0
    assert records(spark, f"{scratch}/many").groupBy("file").count().count() == 3


def test_types_missing_columns_and_errors(spark, scratch):
    write(f"{scratch}/n/one.csv", [["n", "d", "extra"], ["1", "2024-01-31", "x"], ["", "", ""]])
    schema = schemas._struct(("d", schemas._D), ("n", schemas._I))
    df = read_csv_records(spark, f"{scratch}/n", schema)
    assert df.schema == schema and sorted(map(str, df.collect())) == sorted(
        ["Row(d=datetime.date(2024, 1, 31), n=1)", "Row(d=None, n=None)"])
    with pytest.raises(ValueError, match="Missing expected columns"):
        read_csv_records(spark, f"{scratch}/n", schemas._struct(("z", schemas._I)))
    write(f"{scratch}/bad/one.csv", [["n"], ["1"], ["no number"]])
    with pytest.raises(Exception):
        read_csv_records(spark, f"{scratch}/bad", schemas._struct(("n", schemas._I))).collect()
    write(f"{scratch}/two/a.csv", [["n", "m"], ["1", "2"]])
    write(f"{scratch}/two/b.csv", [["m", "n"], ["1", "2"]])
    with pytest.raises(Exception, match="another header"):
        read_csv_records(spark, f"{scratch}/two").collect()
    with open(f"{scratch}/open.csv", "w") as f:
        f.write('a,b\n1,"never closed\n')
    with pytest.raises(Exception, match="not closed"):
        read_csv_records(spark, f"{scratch}/open.csv").collect()


def test_filters_on_typed_columns(spark, scratch):
    """Later filters meet the parsing; a header is never parsed as a row."""
    write(f"{scratch}/f/one.csv", [["n", "d"], *[[str(k), "2024-01-31" if k % 2 else ""] for k in range(50)]])
    df = read_csv_records(spark, f"{scratch}/f", schemas._struct(("n", schemas._I), ("d", schemas._D)))
    assert df.where("n >= 40 AND d IS NOT NULL").count() == 5
    assert df.where("d = DATE '2024-01-31'").select("n").distinct().count() == 25
    assert df.groupBy("d").count().count() == 2


def test_empty_file_of_records(spark, scratch):
    write(f"{scratch}/e/one.csv", [["a", "b"]])
    assert read_csv_records(spark, f"{scratch}/e").columns == ["a", "b"]
    assert read_csv_records(spark, f"{scratch}/e").count() == 0


def test_tables_and_events_use_it(spark, scratch, cut):
    tables = G.tables(spark)
    title = "line one\nline \"two\"\r\nthree, and ''"
    from pyspark.sql import functions as F
    tables["studies"] = tables["studies"].withColumn("brief_title", F.lit(title))
    from trialscope.sinks import write_csv, write_events_csv
    for name, df in tables.items():
        write_csv(df, f"{scratch}/{name}")
    cut(40)
    back = read_tables(spark, scratch, "csv")
    assert {r.brief_title for r in back["studies"].collect()} == {title}
    for name, df in tables.items():
        assert sorted(map(str, back[name].collect())) == sorted(map(str, df.collect()))
    from trialscope import operators as O
    ev = O.upcoming_events(*(tables[n] for n in ("studies", "sponsors", "interventions", "conditions")), G.ASOF, 3)
    got = read_events_csv(spark, write_events_csv(ev, f"{scratch}/ev"))
    assert sorted(map(str, got.collect())) == sorted(map(str, ev.collect()))
    assert "Scan csv" not in got._jdf.queryExecution().toString()
