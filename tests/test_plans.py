"""Plan shape: filters and column lists reach the scan, aggregations combine
map-side before shuffling, and nothing large is funnelled into one task."""

import os

import pytest
from pyspark.sql import functions as F

from trialscope import operators as O
from trialscope.sources import read_tables

from . import golden as G


def plan(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    for name, df in G.tables(spark).items():
        df.write.parquet(os.path.join(root, name))
    return read_tables(spark, root)


def test_counts_push_filters_and_prune_columns(files):
    p = plan(O.upcoming_counts(files["studies"], "start_date", G.ASOF, 12))
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters")]
    assert len(pushed) == 1
    for f in ("EqualTo(study_type,INTERVENTIONAL)", "In(overall_status",
              "GreaterThanOrEqual(start_date,2024-11-30)", "LessThan(start_date,2025-11-30)"):
        assert f in pushed[0]
    read = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")][0]
    assert "brief_title" not in read and "nct_id" not in read  # pruned
    tree = p.split("\n\n")[0]
    assert "partial_count" in p and tree.count("Exchange") == 1


def test_event_candidates_push_the_or_of_windows(files):
    cand = O.upcoming_studies(files["studies"], G.ASOF, 3)
    p = plan(cand)
    assert "Or(" in p and "start_date" in p and "completion_date" in p
    assert "EqualTo(study_type,INTERVENTIONAL)" in p


def test_summaries_split_a_study_before_its_list(files):
    for df in (O.intervention_summary(files["interventions"]), O.condition_summary(files["conditions"])):
        p = plan(df)
        parts = [ln for ln in p.splitlines() if "hashpartitioning(nct_id" in ln]
        assert any("kind" in ln and "value" in ln for ln in parts)  # values of one study on many tasks
        tree = p.split("\n\n")[0].splitlines()
        ex = [i for i, ln in enumerate(tree) if "Exchange" in ln]
        assert len(ex) == 2 and "HashAggregate" in "".join(tree[ex[1] + 1:])  # deduplicated before any shuffle


def jobs_started(spark, build):
    spark.sparkContext.setJobGroup("building", "none may start")
    try:
        return build(), len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_event_table_is_one_lazy_plan_that_filters_first(spark, files):
    t = files
    ev, jobs = jobs_started(spark, lambda: O.upcoming_events(
        t["studies"], t["sponsors"], t["interventions"], t["conditions"], G.ASOF, 3))
    assert jobs == 0
    for hint in (None, "merge"):  # broadcast or shuffle: each table meets the ids below its aggregates
        p = plan(O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"], G.ASOF, 3,
                                   join_hint=hint)).split("\n\n")[0].splitlines()
        semi = [i for i, ln in enumerate(p) if "Join LeftSemi" in ln]
        assert len(semi) == 3
        for i in semi:
            assert "Aggregate" not in "".join(p[i:i + 8])


def test_phase_reports_scan_the_studies_once(files):
    for df in (O.phase_status_capped(files["studies"]), O.phase_status_counts(files["studies"])):
        assert plan(df).split("\n\n")[0].count("Scan parquet") == 1
    long = O.landed_counts(files["studies"])
    for df in (O.matrix_of(long), O.capped_of(long)):
        assert "Scan parquet" not in plan(df)


@pytest.fixture()
def written_events(spark, tmp_path):
    from trialscope.sources import read_events_parquet
    t = G.tables(spark)
    path = str(tmp_path / "ev")
    O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"], G.ASOF, 3).write.parquet(path)
    return read_events_parquet(spark, path)


CHARTS = {
    "sponsors": lambda ev, s: O.top_sponsor_phase(ev, 12, s),
    "phases": O.events_by_phase,
    "statuses": O.events_by_status,
    "types": lambda ev, s: O.top_intervention_types(ev, 20, s),
}


@pytest.mark.parametrize("sponsors", [None, "Acme, Nobody"])
@pytest.mark.parametrize("name", CHARTS)
def test_charts_count_by_hash_and_break_ties_in_a_narrow_pass(spark, written_events, name, sponsors):
    """One hash aggregation over the events; ids are read in a second pass
    that joins the keys which can still win, without the counted columns."""
    df, jobs = jobs_started(spark, lambda: CHARTS[name](written_events, sponsors))
    assert jobs == 0  # also for a sponsor selection
    p = plan(df)
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p and "HashAggregate" in p
    main = p.split("\n\n")[0]
    assert main.count("Scan parquet") <= 3
    ties = [ln for ln in p.splitlines() if ln.startswith("ReadSchema") and "nct_id" in ln]
    assert ties and not any("title" in ln or "conditions" in ln for ln in ties)
    if name == "sponsors":
        assert main.count("Scan parquet") == 2 and not any("phase_std" in ln for ln in ties)
    assert "WindowGroupLimit" in p  # one row a key and task goes on


def test_ranking_materialises_order_columns_only(spark, written_events):
    seen = []
    whole = type(written_events).checkpoint

    def spy(self, *a, **k):
        seen.append(self.columns)
        return whole(self, *a, **k)
    type(written_events).checkpoint = spy
    try:
        ranked = O.global_rank(written_events, O.events.event_order_keys())
    finally:
        type(written_events).checkpoint = whole
    assert seen == [["__o0", "__o1", "__o2", "__n", "__part"]]
    reads = [ln for ln in plan(ranked).splitlines() if ln.startswith("ReadSchema")]
    assert len(reads) == 1 and "conditions" in reads[0]  # the wide rows are read by the action
    assert [r.rk for r in ranked.orderBy("rk").collect()] == [1, 2, 3, 4, 5, 6]


def test_equal_rows_share_a_rank(spark):
    df = spark.createDataFrame([(k % 7, str(k)) for k in range(40)] + [(None, "x")] * 3, "a int, b string").repartition(5)
    got = O.global_rank(df, ["a"], num_partitions=4).collect()
    want = sorted((r.a is not None, r.a or 0) for r in df.collect())
    assert len(got) == 43 and all(want.index((r.a is not None, r.a or 0)) + 1 == r.rk for r in got)


def test_all_count_reports_come_from_one_scan(spark, files, tmp_path, monkeypatch):
    studies = files["studies"]
    summary = O.study_summary(studies, G.ASOF, 12, 12)
    assert plan(summary).split("\n\n")[0].count("Scan parquet") == 1
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(O.counts_from_summary(summary), O.phase_status_counts(studies))
    assert same(O.timeline_from_summary(summary, G.ASOF, 12), O.upcoming_timeline(studies, G.ASOF, 12))
    assert same(O.bars_from_summary(summary), O.upcoming_bars_all(studies, G.ASOF, 12))
    # different horizons in one summary, and summaries of two halves add up
    mixed = O.study_summary(studies.where("nct_id < 'N04'"), G.ASOF, 2, 3).union(
        O.study_summary(studies.where("nct_id >= 'N04'"), G.ASOF, 2, 3))
    assert same(O.counts_from_summary(mixed), O.phase_status_counts(studies))
    assert same(O.timeline_from_summary(mixed, G.ASOF, 2), O.upcoming_timeline(studies, G.ASOF, 2))
    assert same(O.bars_from_summary(mixed), O.upcoming_bars_all(studies, G.ASOF, 3))


def test_the_quantile_needs_no_window(files):
    p = plan(O.phase_status_capped(files["studies"]))
    windows = [ln for ln in p.splitlines() if "windowspecdefinition" in ln]
    assert windows and all("windowspecdefinition(phase_std" in ln for ln in windows)


def test_emptiness_is_known_from_the_write(spark, tmp_path):
    from trialscope.sinks import write_csv, write_unless_empty
    df = spark.range(100, numPartitions=4).withColumn("n", F.col("id") % 3)
    path = str(tmp_path / "t")

    def jobs(f):
        spark.sparkContext.setJobGroup(path, "")
        out = f()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(path))
    out, n = jobs(lambda: write_unless_empty(df, write_csv, path, counted=F.col("n") == 2))
    assert out == path and n == 1 and spark.read.csv(path, header=True).count() == 100
    assert write_unless_empty(df.where("n = 5"), write_csv, path) is None
    assert spark.read.csv(path, header=True).count() == 100  # what was there stays
    assert write_unless_empty(df, write_csv, path, counted=F.col("n") == 5) is None
    assert os.listdir(tmp_path) == ["t"]


def test_bars_broadcast_only_the_bounded_counts(files):
    p = plan(O.upcoming_phase_status(files["studies"], "start_date", G.ASOF, 12))
    assert "BroadcastHashJoin" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_no_cross_joins_anywhere(files):
    t = files
    ev = O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"], G.ASOF, 3)
    for df in (O.phase_status_capped(t["studies"]), O.upcoming_timeline(t["studies"], G.ASOF, 3),
               O.top_sponsor_phase(ev, 12), O.top_intervention_types(ev, 5), ev):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_top_n_uses_take_ordered(files):
    t = files
    ev = O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"], G.ASOF, 3)
    assert "TakeOrderedAndProject" in plan(O.top_intervention_types(ev, 5))


def test_snapshot_partition_pruning(spark, tmp_path):
    root = str(tmp_path)
    for snap in ("2024-11-29", "2024-11-30"):
        for name, df in G.tables(spark).items():
            df.write.parquet(os.path.join(root, name, f"snapshot={snap}"))
    t = read_tables(spark, root, snapshot="2024-11-30")
    p = plan(O.phase_status_counts(t["studies"]))
    assert "PartitionFilters: [isnotnull(snapshot" in p and "(snapshot#" in p and "2024-11-30" in p
    ev = O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"], G.ASOF, 3)
    assert ev.count() == len(G.EVENTS)  # one snapshot, not two
