"""Bucketed and clustered storage, and split points of a text key."""

import datetime as dt
import glob
import os
import random
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trialscope import config as C
from trialscope import operators as O
from trialscope import schemas
from trialscope.sinks import layout, read_bucketed, write_bucketed, write_clustered
from trialscope.sinks.layout import interleaved
from trialscope.sources import equi_depth_bounds, nct_id_predicates

from . import golden as G
from .test_plans import plan


def test_event_table_over_buckets_shuffles_nothing(spark):
    tables = G.tables(spark)
    write_bucketed(tables, "bucketed_test", 4)
    t = read_bucketed(spark, "bucketed_test")
    ev = O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"], G.ASOF, 3, join_hint="merge")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(ev).split("\n\n")[0]
        assert "Exchange" not in p and p.count("SortMergeJoin") == 6
        want = O.upcoming_events(*(tables[n] for n in ("studies", "sponsors", "interventions", "conditions")), G.ASOF, 3)
        assert sorted(map(str, ev.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _wide_studies(spark):
    """640 studies of 1 MB each."""
    days = [F.date_add(F.lit(dt.date(2012, 1, 1)), (F.col("id") % 500).cast("int")).alias(d) for d in C.DATE_COLUMNS]
    df = spark.range(0, 640, 1, 8).select("*", *days, F.repeat(F.lit("x"), 1 << 20).alias("brief_title"),
                                          F.format_string("NCT%08d", "id").alias("nct_id"))
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schemas.STUDIES.fields])


def test_buckets_grow_with_the_largest_table(spark):
    tables = G.tables(spark) | {"studies": _wide_studies(spark)}
    write_bucketed(tables, "wide_test", 2)
    back = read_bucketed(spark, "wide_test")
    assert len(back["studies"].inputFiles()) == 3  # 640 MB, 256 MB each
    found = spark.sql("DESCRIBE EXTENDED wide_test_sponsors").where("col_name = 'Num Buckets'").first()
    assert found.data_type == "3"
    assert back["studies"].select("nct_id", F.length("brief_title")).distinct().count() == 640
    for name in ("sponsors", "interventions", "conditions"):
        assert sorted(map(str, back[name].collect())) == sorted(map(str, tables[name].collect()))


def _shuffled(spark):
    """MB in shuffle files, which go a moment after a write."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    size = lambda: sum(os.path.getsize(f) for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data"))
    least = size()
    for _ in range(20):
        time.sleep(0.25)
        least = min(least, size())
    return least / 2 ** 20


def _random_studies(spark):
    """320 studies of 256 KB each that no codec makes smaller by much."""
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(4096)), lambda k: F.sha2(F.concat_ws("-", "id", k), 256)))
    return _wide_studies(spark).withColumn("id", F.substring("nct_id", 4, 8)).where("id < 320").withColumn(
        "brief_title", text).drop("id")


def test_large_buckets_are_written_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(layout, "ROUND_BYTES", 20 << 20)
    monkeypatch.setattr(layout, "PART_BYTES", 10 << 20)
    studies = _random_studies(spark)
    before = _shuffled(spark)
    tables = G.tables(spark) | {"studies": studies}
    write_bucketed(tables, "rounds_test", 2)
    assert _shuffled(spark) <= before + 1  # nothing of some 45 MB stays
    back = read_bucketed(spark, "rounds_test")
    assert len(back["studies"].inputFiles()) == 9  # 80 MB, 10 MB each: one file a bucket, from five rounds
    assert back["studies"].exceptAll(studies).count() == 0 and studies.exceptAll(back["studies"]).count() == 0
    for name in ("sponsors", "interventions", "conditions"):
        assert sorted(map(str, back[name].collect())) == sorted(map(str, tables[name].collect()))
    assert spark.conf.get(layout.CLEANUP) == "false"
    write_bucketed(tables, "rounds_test", 2)
    assert read_bucketed(spark, "rounds_test")["studies"].count() == 320


def test_large_clustered_tables_are_written_in_rounds(spark, scratch, monkeypatch):
    monkeypatch.setattr(layout, "ROUND_BYTES", 20 << 20)
    monkeypatch.setattr(layout, "PART_BYTES", 10 << 20)
    studies = _random_studies(spark)
    before = _shuffled(spark)
    for _ in range(2):  # the second takes the first one's place
        write_clustered(studies, f"{scratch}/rounds", 2)
    assert _shuffled(spark) <= before + 1
    files = glob.glob(f"{scratch}/rounds/*.parquet")
    assert 9 <= len(files) <= 12
    back = spark.read.parquet(f"{scratch}/rounds")
    assert back.exceptAll(studies).count() == 0 and studies.exceptAll(back).count() == 0
    ranges = sorted((pq.read_table(f, columns=["start_date"])["start_date"].to_pylist() for f in files), key=min)
    assert all(max(a) <= min(b) for a, b in zip(ranges, ranges[1:]))  # the three dates are one here
    # one place for all rows: one round
    write_clustered(studies.withColumns({d: F.lit(dt.date(2012, 1, 1)) for d in C.DATE_COLUMNS}), f"{scratch}/same", 2)
    assert spark.read.parquet(f"{scratch}/same").count() == 320


def test_bits_are_interleaved(spark):
    day = lambda n: dt.date(1900, 1, 1) + dt.timedelta(n)
    rows = [(day(5), day(3), day(6)), (None, day(1), None), (dt.date(1800, 1, 1), day(0), dt.date(2900, 1, 1))]
    df = spark.createDataFrame(rows, "a date, b date, c date")
    got = [r[0] for r in df.select(interleaved(["a", "b", "c"])).collect()]

    def plain(*days):
        return sum((n >> b & 1) << 3 * b + k for k, n in enumerate(days) for b in range(16))
    assert got == [plain(5, 3, 6), plain(0, 1, 0), plain(0, 0, 65535)]
    with pytest.raises(ValueError):
        interleaved(C.DATE_COLUMNS, 30)


def _studies(spark, n, seed=0):
    rng, rows = random.Random(seed), []
    for k in range(n):
        start = dt.date(2000, 1, 1) + dt.timedelta(rng.randrange(20 * 365))
        primary = start + dt.timedelta(rng.randrange(2000))
        end = primary + dt.timedelta(rng.randrange(1000))
        dates = [d if rng.random() > 0.05 else None for d in (start, primary, end)]
        rows.append((f"NCT{k:08d}", "INTERVENTIONAL", "PHASE1", "RECRUITING", "t", 1, "ACTUAL", start,
                     dates[0], None, dates[1], None, dates[2], None))
    return spark.createDataFrame(rows, schemas.STUDIES)


def _groups_read(path, asof, end):
    """(row groups whose dates' ranges meet the window, all of them)."""
    hit = every = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.read_metadata(f)
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(at[d]).statistics for d in C.DATE_COLUMNS]
            hit += any(s.has_min_max and s.min < end and s.max >= asof for s in stats)
            every += 1
    return hit, every


def test_clustered_studies_are_mostly_skipped(spark, scratch):
    studies = _studies(spark, 20_000)
    write_clustered(studies, f"{scratch}/by_dates", 64)
    studies.repartition(64).write.parquet(f"{scratch}/plain")
    studies.repartitionByRange(64, "start_date").sortWithinPartitions("start_date").write.parquet(f"{scratch}/by_start")
    asof, end = dt.date(2012, 3, 1), dt.date(2012, 6, 1)
    plain, one, three = (_groups_read(f"{scratch}/{p}", asof, end) for p in ("plain", "by_start", "by_dates"))
    assert plain[0] == plain[1]            # nothing is skipped
    assert three[0] <= 0.4 * three[1] and three[0] < one[0]
    want = O.upcoming_studies(studies, asof, 3)
    got = O.upcoming_studies(spark.read.parquet(f"{scratch}/by_dates"), asof, 3)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_clustered_files_grow_with_the_table(spark, scratch):
    wide = _wide_studies(spark)
    write_clustered(wide, f"{scratch}/wide", 2)
    files = glob.glob(f"{scratch}/wide/*.parquet")
    assert len(files) == 3  # 640 MB, 256 MB each
    assert max(pq.read_metadata(f).num_rows for f in files) < 300
    back = spark.read.parquet(f"{scratch}/wide")
    assert back.exceptAll(wide).count() == 0 and wide.exceptAll(back).count() == 0


def test_derived_bounds_give_even_ranges(spark, scratch):
    """Ids crowd at one end and differ in length; a third are one id."""
    rng = random.Random(1)
    ids = [f"NCT{int(10 ** (rng.random() * 8)):08d}" for _ in range(40_000)] + ["NCT00000777"] * 20_000 + ["nct-odd", None]
    spark.createDataFrame([(i,) for i in ids], "nct_id string").repartition(6).write.parquet(f"{scratch}/ids")
    df = spark.read.parquet(f"{scratch}/ids")
    bounds = equi_depth_bounds(df, 12)
    counts = [df.where(p).count() for p in nct_id_predicates(bounds)]
    assert sum(counts) == len(ids) and len(bounds) >= 7
    fair = len(ids) / 12
    even = [c for c in counts if c < 20_000]  # the range of the frequent id cannot be cut
    assert len(counts) - len(even) == 1 and max(even) < 1.6 * fair
    assert equi_depth_bounds(df.limit(0), 12) == []
