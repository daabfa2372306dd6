"""Golden results on the hand-written rows of FIXTURES.md §3."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trialscope import TrialReports
from trialscope import config as C
from trialscope import operators as O
from trialscope import schemas

from . import golden as G


@pytest.fixture(scope="module")
def t(spark):
    return G.tables(spark)


@pytest.fixture(scope="module")
def events(t):
    return O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"],
                             G.ASOF, 3)


def test_event_table_rows_and_order(events):
    rows = O.sort_events(events).collect()
    got = [(r.event_date, r.event_type, r.event_date_type, r.nct_id, r.phase_std, r.lead_sponsor,
            r.intervention_types, r.interventions, r.conditions) for r in rows]
    assert got == G.EVENTS
    assert all(r.title == "t" * C.TITLE_CHARS for r in rows)
    assert [r.enrollment for r in rows] == [1234, 1234, 1234, 1234, None, 1234]
    assert events.columns == list(schemas.EVENT_COLUMNS)


def test_event_table_with_shuffle_joins_gives_same_rows(t, events):
    whole = O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"],
                              G.ASOF, 3, join_hint="merge")
    assert sorted(whole.collect()) == sorted(events.collect())


def test_union_strategy_equals_explode(t, events):
    union = O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"],
                              G.ASOF, 3, strategy="union")
    assert union.exceptAll(events).isEmpty() and events.exceptAll(union).isEmpty()


def test_ranked_events(events):
    from trialscope.operators.events import event_order_keys
    ranked = O.global_rank(events, event_order_keys()).orderBy("rk").collect()
    assert [r.rk for r in ranked] == list(range(1, 7))
    assert [(r.nct_id, r.event_type) for r in ranked] == [(e[3], e[1]) for e in G.EVENTS]


def test_display_view(events):
    vals = {r.nct_id: r.enrollment for r in O.display_events(events).collect()}
    assert vals == {"N01": "1,234", "N07": "1,234", "N02": ""}


def test_lead_sponsor_min_name_skips_nulls(t):
    got = {r.nct_id: r.lead_sponsor for r in O.lead_sponsor_by_study(t["studies"], t["sponsors"]).collect()}
    assert got["N01"] == "Acme"      # Beta, Acme, null -> Acme
    assert got["N02"] is None        # only a collaborator
    assert got["N07"] == " Acme "    # kept as is; trimmed only in charts
    assert "N03" not in got          # observational


def test_summaries_empty_sets_are_null(t):
    iv = {r.nct_id: r for r in O.intervention_summary(t["interventions"]).collect()}
    assert iv["N01"].intervention_types == "DEVICE, DRUG"
    assert iv["N01"].interventions == G.X60 + " · y"
    assert iv["N02"].intervention_types is None and iv["N02"].interventions is None
    cond = {r.nct_id: r.conditions for r in O.condition_summary(t["conditions"]).collect()}
    assert cond == {"N01": "a, b"}


def test_phase_status_counts(t):
    got = {(r.phase_std, r.status): r.n for r in O.phase_status_counts(t["studies"]).collect()}
    assert got == G.PHASE_STATUS


def test_matrix_columns_and_zero_fill(t):
    m = O.phase_status_matrix(t["studies"])
    assert m.columns == ["phase_std", "NOT_YET_RECRUITING", "RECRUITING", "ENROLLING_BY_INVITATION",
                         "ACTIVE_NOT_RECRUITING", "COMPLETED", "UNKNOWN", "WITHHELD"]
    rows = m.collect()
    assert [r.phase_std for r in rows] == sorted(r.phase_std for r in rows)
    p4 = [r for r in rows if r.phase_std == "Phase 4"][0]
    assert (p4.COMPLETED, p4.WITHHELD, p4.RECRUITING) == (1, 1, 0)


def test_quantile_counts_zero_cells(spark):
    rows = ([("x", "INTERVENTIONAL", "PHASE1", "x")] * 100
            + [("y", "INTERVENTIONAL", "PHASE2", "y")] * 10)
    studies = spark.createDataFrame(
        [(f"N{i}", st, ph, s) for i, (_, st, ph, s) in enumerate(rows)],
        "nct_id string, study_type string, phase string, overall_status string")
    capped = O.phase_status_capped(studies).collect()
    assert len(capped) == 4
    assert {r.z95 for r in capped} == {86}
    assert {(r.phase_std, r.status): (r.n, r.n_capped) for r in capped} == {
        ("Phase 1", "x"): (100, 86), ("Phase 1", "y"): (0, 0),
        ("Phase 2", "x"): (0, 0), ("Phase 2", "y"): (10, 10)}


def test_timeline(t):
    got = [tuple(r) for r in O.upcoming_timeline(t["studies"], G.ASOF, 3).collect()]
    D = dt.date
    assert got == [(D(2024, 11, 1), 1, 0, 0), (D(2024, 12, 1), 0, 0, 0),
                   (D(2025, 1, 1), 1, 1, 1), (D(2025, 2, 1), 1, 0, 1)]


def test_timeline_asof_first_of_month_has_empty_last_month(t):
    got = O.upcoming_timeline(t["studies"], dt.date(2024, 11, 1), 3).collect()
    assert [r.month for r in got] == [dt.date(2024, 11, 1), dt.date(2024, 12, 1),
                                      dt.date(2025, 1, 1), dt.date(2025, 2, 1)]
    assert tuple(got[-1])[1:] == (0, 0, 0)


def test_timeline_long(t):
    long = O.timeline_long(O.upcoming_timeline(t["studies"], G.ASOF, 3))
    assert long.count() == 12
    assert long.agg(F.sum("count")).first()[0] == 6


def test_bars_dense_grid(t):
    bars = O.upcoming_phase_status(t["studies"], "start_date", G.ASOF, 3).collect()
    assert len(bars) == 36
    nonzero = {(r.phase_std, r.status): r["count"] for r in bars if r["count"]}
    assert nonzero == {("Phase 1/2", "RECRUITING"): 1, ("Unknown", "NOT_YET_RECRUITING"): 1,
                       ("Early Phase 1", "ENROLLING_BY_INVITATION"): 1}
    assert [r.phase_std for r in bars[::4]] == list(C.PHASE_ORDER)
    assert [r.status for r in bars[:4]] == list(C.ACTIVE_STATUSES)
    totals = {r.phase_std: r.phase_total for r in bars}
    assert totals["Phase 1/2"] == 1 and totals["Phase 3"] == 0


def test_bars_all_matches_single_column_bars(t):
    allb = {(r.date_column, r.phase_std, r.status): r["count"]
            for r in O.upcoming_bars_all(t["studies"], G.ASOF, 3).collect()}
    for col in C.DATE_COLUMNS:
        one = {(col, r.phase_std, r.status): r["count"]
               for r in O.upcoming_phase_status(t["studies"], col, G.ASOF, 3).collect()}
        assert {k: v for k, v in allb.items() if k[0] == col} == one


def test_top_sponsors(events):
    got = O.top_sponsor_phase(events, 12).collect()
    totals = {r.sponsor: (r.total, r.rk) for r in got}
    assert totals == {"Acme": (5, 1), "Unknown": (1, 2)}
    assert len(got) == 2 * 9
    acme = {r.phase_std: r.n for r in got if r.sponsor == "Acme"}
    assert acme["Phase 1/2"] == 2 and acme["Early Phase 1"] == 3 and acme["Phase 3"] == 0


def test_top_sponsors_n_clamps(events):
    assert O.top_sponsor_phase(events, 1).select("sponsor").distinct().collect()[0][0] == "Acme"
    assert O.top_sponsor_phase(events, 0).select("sponsor").distinct().count() == 2


def test_events_by_phase_and_status(events):
    ph = [(r.phase_std, r.n, r.rk) for r in O.events_by_phase(events).orderBy("rk").collect()]
    assert ph == [("Early Phase 1", 3, 1), ("Phase 1/2", 2, 2), ("Unknown", 1, 3)]
    st = [(r.status, r.n) for r in O.events_by_status(events).orderBy("rk").collect()]
    assert st == [("RECRUITING", 2), ("ENROLLING_BY_INVITATION", 3), ("NOT_YET_RECRUITING", 1)]


def test_top_intervention_types_tie_by_place_in_list(events):
    got = [(r.intervention_type, r.n, r.rk)
           for r in O.top_intervention_types(events, 20).orderBy("rk").collect()]
    assert got == [("DEVICE", 2, 1), ("DRUG", 2, 2)]


def test_sponsor_filter(events):
    assert O.chart_view(events, ["Nobody"]).count() == 6
    assert O.chart_view(events, "Acme, Nobody").count() == 5
    assert O.chart_view(events, "").count() == 6
    assert O.chart_view(events, ["Unknown"]).count() == 1


def _event(day, kind, nct, sponsor="S", types=None, phase="Phase 1", status="RECRUITING"):
    import datetime as dt
    return (dt.date(2025, 1, day) if day else None, kind, nct, sponsor, types, phase, status)


def _event_table(spark, rows):
    return spark.createDataFrame(rows, "event_date date, event_type string, nct_id string, lead_sponsor string, "
                                       "intervention_types string, phase_std string, status string").repartition(5)


def test_chart_ties_follow_first_appearance(spark):
    """Equal counts: day, then kind, then study id, then place in the list."""
    ev = _event_table(spark, [
        _event(3, "START", "N9", "late"), _event(2, "COMPLETION", "N1", "kind"), _event(2, "START", "N5", "id5"),
        _event(2, "START", "N4", "id4"), _event(2, "START", "N4", "id4b"), _event(1, "COMPLETION", "N8", "early")])
    got = [r.sponsor for r in O.top_sponsor_phase(ev, 50).select("sponsor", "rk").distinct().orderBy("rk").collect()]
    assert got[0] == "early" and set(got[1:3]) == {"id4", "id4b"} and got[3:] == ["id5", "kind", "late"]
    for n in range(1, 7):  # the cut falls into the ties
        cut = O.top_sponsor_phase(ev, n).select("sponsor", "rk").distinct().orderBy("rk").collect()
        assert [r.rk for r in cut] == list(range(1, n + 1)) and cut[0].sponsor == "early"
        assert {r.sponsor for r in cut} <= set(got[:max(n, 3)])
    types = _event_table(spark, [_event(2, "START", "N2", types="C, A,B"), _event(2, "START", "N1", types="Z,A ,, Y"),
                                 _event(1, "START", "N7", types=" , ")])
    got = [r.intervention_type for r in O.top_intervention_types(types, 20).orderBy("rk").collect()]
    assert got == ["A", "Z", "Y", "C", "B"]
    other = _event_table(spark, [_event(2, "START", "N2", status="ODD"), _event(2, "START", "N1", status="STRANGE"),
                                 _event(9, "START", "N3", status="COMPLETED"), _event(None, "START", "N4", status="NEW")])
    assert [r.status for r in O.events_by_status(other).orderBy("rk").collect()] == ["COMPLETED", "NEW", "STRANGE", "ODD"]


def test_a_selection_counts_only_known_sponsors(spark):
    ev = _event_table(spark, [_event(1, "START", "N1", "A", "X"), _event(1, "START", "N2", "B", "Y"),
                              _event(1, "START", "N3", "C", None)])
    pick = lambda s: {r.intervention_type for r in O.top_intervention_types(ev, 9, s).collect()}
    assert pick("B, nobody") == {"Y"} and pick("nobody") == {"X", "Y"} and pick("C") == set() and pick(None) == {"X", "Y"}
    assert {r.sponsor for r in O.top_sponsor_phase(ev, 9, ["B", "C"]).collect()} == {"B", "C"}
    assert O.events_by_phase(ev, "nobody").first().n == 3 and O.events_by_phase(ev, "A").first().n == 1


def test_sponsor_list_orders_case_and_accents(spark):
    names = ["Zentrum", "zentrum", "z\u00e9ntrum", "Z\u00e9ntrum", "\u00c9cole", "eclair", "Eclair", "apple", "Apple"]
    ev = spark.createDataFrame([(n,) for n in names], "lead_sponsor string")
    assert [r.sponsor for r in O.sorted_sponsor_list(ev).collect()] == [
        "apple", "Apple", "eclair", "Eclair", "\u00c9cole", "zentrum", "Zentrum", "z\u00e9ntrum", "Z\u00e9ntrum"]


def test_sponsor_list_locale_order(spark):
    ev = spark.createDataFrame([(n,) for n in ["b", "A", "a", None, "  "]], "lead_sponsor string")
    assert [r.sponsor for r in O.sorted_sponsor_list(ev).collect()] == ["a", "A", "b", "Unknown"]


def test_matrix_columns_given_set_the_order_only(spark, t):
    m = O.phase_status_matrix(t["studies"], ["WITHDRAWN", "RECRUITING"])
    cells = sum(sum(r[1:]) for r in m.collect())
    assert cells == t["studies"].where("study_type = 'INTERVENTIONAL'").count()
    whole = O.phase_status_matrix(t["studies"])
    assert set(m.columns) == set(whole.columns) and m.columns[1] in ("WITHDRAWN", "RECRUITING")


def test_horizon_of_zero_months(t):
    tl = O.upcoming_timeline(t["studies"], G.ASOF, 0).collect()
    assert [(str(r.month), sum(r[1:])) for r in tl] == [("2024-11-01", 0)]


def test_report_job_writes_everything(t, scratch):
    rep = TrialReports.from_tables(t, asof=G.ASOF, table_months=3, bars_months=1,
                                   timeline_months=3)
    out = rep.write_all(scratch)
    assert out["events_csv"] and out["events_parquet"]
    # in [2024-11-30, 2024-12-30) only N01 starts; no active study completes
    assert out["bars_start_date"] is not None
    assert out["bars_primary_completion_date"] is None
    assert out["bars_completion_date"] is None
    assert all(out[k] for k in ("timeline_long", "events_json", "events_display", "phase_status_capped"))
    bars = t["studies"].sparkSession.read.option("header", True).csv(out["bars_start_date"])
    assert "total_label" in bars.columns and bars.count() == 36


def test_asof_none_is_fixed_once(spark, t):
    from trialscope.functions.columns import resolve_asof
    today = resolve_asof(spark, None)
    assert isinstance(today, dt.date)
    assert TrialReports.from_tables(t).asof == today
    assert resolve_asof(spark, "2024-11-30") == G.ASOF


def test_categories_outside_the_preferred_order_sort_last_by_first_appearance(spark):
    D = dt.date
    rows = [(D(2025, 1, 1), "START", "N1", "Zeta"), (D(2025, 1, 2), "START", "N2", "Phase 1"),
            (D(2025, 1, 3), "START", "N3", None), (D(2025, 1, 4), "START", "N4", "Alpha"),
            (D(2025, 1, 5), "START", "N5", "Zeta"), (D(2025, 1, 6), "START", "N6", "Early Phase 1")]
    ev = spark.createDataFrame(rows, "event_date date, event_type string, nct_id string, phase_std string")
    got = [(r.phase_std, r.n) for r in O.events_by_phase(ev).orderBy("rk").collect()]
    assert got == [("Early Phase 1", 1), ("Phase 1", 1), ("Zeta", 2), ("", 1), ("Alpha", 1)]


def test_empty_window_and_empty_tables(spark, t):
    far = dt.date(2100, 1, 1)
    ev = O.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"], far, 3)
    assert ev.count() == 0
    for df in (O.top_sponsor_phase(ev, 12), O.top_sponsor_phase(ev, 12, "Acme"),
               O.events_by_phase(ev), O.top_intervention_types(ev), O.sponsor_list(ev),
               O.global_rank(ev, O.events.event_order_keys())):
        assert df.count() == 0
    tl = O.upcoming_timeline(t["studies"], far, 3).collect()
    assert len(tl) == 4 and all(sum(r[1:]) == 0 for r in tl)
    bars = O.upcoming_phase_status(t["studies"], "start_date", far, 3).collect()
    assert len(bars) == 36 and all(r["count"] == 0 for r in bars)
    empty = spark.createDataFrame([], schemas.STUDIES)
    assert O.phase_status_matrix(empty).count() == 0
    assert O.phase_status_capped(empty).count() == 0


def test_matrix_handles_odd_status_names(spark):
    df = spark.createDataFrame(
        [("a", "INTERVENTIONAL", "PHASE1", "odd.`name`"), ("b", "INTERVENTIONAL", "PHASE2", "RECRUITING")],
        "nct_id string, study_type string, phase string, overall_status string")
    m = O.phase_status_matrix(df)
    assert m.columns == ["phase_std", "RECRUITING", "odd.`name`"]
    assert [tuple(r) for r in m.collect()] == [("Phase 1", 0, 1), ("Phase 2", 1, 0)]


def test_every_phase_spelling(spark):
    cases = [(raw, label) for label, spellings in C.PHASE_SPELLINGS.items() for raw in spellings]
    cases += [(None, "Unknown"), ("phase1", "Unknown"), ("PHASE9", "Unknown"), ("", "Unknown"),
              (" PHASE1", "Unknown")]
    assert len(cases) == 25
    df = spark.createDataFrame([(f"N{i}", "INTERVENTIONAL", raw, "RECRUITING")
                                for i, (raw, _) in enumerate(cases)],
                               "nct_id string, study_type string, phase string, overall_status string")
    from trialscope.functions import phase_std
    got = {r.nct_id: r.p for r in df.select("nct_id", phase_std("phase").alias("p")).collect()}
    assert got == {f"N{i}": label for i, (_, label) in enumerate(cases)}
