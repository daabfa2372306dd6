"""Upcoming milestones: one row per (study, event kind) in a date window.

Plan shape (one scan per input table):

* `studies` is read with study type, active status and "any of the three
  dates in the window" as plain column predicates, so they reach the parquet
  / JDBC scan.
* `sponsors`, `interventions` and `conditions` are semi-joined with the
  candidate ids first and then reduced to one row per study, so the shuffles
  carry rows of upcoming studies only. Broadcast or shuffle is left to Spark
  (threshold, AQE). The lists are deduplicated on (study, value) before they
  are collected, which spreads a study with very many rows over tasks.
* The summaries are joined once per study, then each study is unpivoted into
  up to three event rows with a generator (no self-union, no second scan).
"""


from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import columns as X
from ..schemas import EVENT_COLUMNS

_DATE_AND_TYPE = tuple(c for pair in C.EVENT_SOURCES.values() for c in pair)

# Only active statuses pass, and UNKNOWN (the null default) is not one of
# them, so "coalesce(status, UNKNOWN) in ACTIVE" is "status in ACTIVE" on the
# raw column, which the scan can evaluate.
assert C.UNKNOWN_STATUS not in C.ACTIVE_STATUSES


def interventional(studies: DataFrame) -> DataFrame:
    return studies.where(F.col("study_type") == C.INTERVENTIONAL)


def active(studies: DataFrame) -> DataFrame:
    return studies.where(F.col("overall_status").isin(*C.ACTIVE_STATUSES))


def any_date_in_window(asof, months: int) -> F.Column:
    return reduce(lambda a, b: a | b,
                  [X.in_window(d, asof, months) for d in C.DATE_COLUMNS])


def upcoming_studies(studies: DataFrame, asof: _dt.date | None, months: int) -> DataFrame:
    """Interventional, active studies with at least one milestone in
    [asof, asof + months), projected to the columns the event rows need."""
    return (
        active(interventional(studies))
        .where(any_date_in_window(asof, months))
        .select(
            "nct_id",
            X.left_chars("brief_title", C.TITLE_CHARS).alias("title"),
            X.status_std().alias("status"),
            X.phase_std().alias("phase_std"),
            "enrollment", "enrollment_type", "last_update_posted_date",
            *_DATE_AND_TYPE,
        )
    )


def _event_struct(kind: str):
    date_col, type_col = C.EVENT_SOURCES[kind]
    return F.struct(
        F.col(date_col).cast("date").alias("event_date"),
        F.lit(kind).alias("event_type"),
        F.coalesce(F.col(type_col), F.lit(C.ESTIMATED)).alias("event_date_type"),
    )


def event_rows(df: DataFrame, asof: _dt.date | None, months: int,
               carry=None, strategy: str = "explode") -> DataFrame:
    """Unpivot each study into START / PRIMARY_COMPLETION / COMPLETION rows
    whose own date lies in the window.

    strategy="explode": one pass, a generator over an array of three structs.
    strategy="union": three filtered projections glued by UNION ALL (three
    passes over `df`); same rows, kept for comparison and for sources that
    cannot run generators.
    """
    carry = [c for c in (carry if carry is not None else df.columns) if c not in _DATE_AND_TYPE]
    if strategy == "explode":
        out = df.select(*carry, F.inline(F.array(*[_event_struct(k) for k in C.EVENT_ORDER])))
        return out.where(X.in_window("event_date", asof, months))
    if strategy == "union":
        parts = []
        for kind in C.EVENT_ORDER:
            date_col, _ = C.EVENT_SOURCES[kind]
            parts.append(df.where(X.in_window(date_col, asof, months))
                         .select(*carry, _event_struct(kind).alias("e"))
                         .select(*carry, "e.*"))
        return reduce(lambda a, b: a.unionByName(b), parts)
    raise ValueError(f"unknown strategy {strategy!r}")


# --- per-study summaries -----------------------------------------------------

def lead_sponsors(sponsors: DataFrame) -> DataFrame:
    """First lead sponsor by name per study (nulls only if no named lead).

    min() is the null-skipping "order by name limit 1". Spark sorts to
    aggregate text, so the rows are deduplicated by hash first.
    """
    return (sponsors.where(F.col("lead_or_collaborator") == C.LEAD_ROLE)
            .select("nct_id", "name").distinct()
            .groupBy("nct_id").agg(F.min("name").alias("lead_sponsor")))


def _distinct_lists(df: DataFrame, values, lists) -> DataFrame:
    """Per study, sorted-distinct lists of several columns. A row becomes one
    (study, column number, value) each; these are deduplicated map-side and
    over all tasks before a study's values meet, so a study with a large part
    of all rows is no single task's work. Studies with nulls only stay."""
    each = df.select("nct_id", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in enumerate(values)])).alias("v"))
    once = each.select("nct_id", "v.kind", "v.value").distinct()
    return once.groupBy("nct_id").agg(*[
        X.sorted_join(F.when(F.col("kind") == k, F.col("value")), sep).alias(name)
        for k, (name, sep) in enumerate(lists)])


def intervention_summary(interventions: DataFrame) -> DataFrame:
    """Per study: distinct intervention types joined by ', ' and distinct
    60-character names joined by ' · ', both in binary order."""
    return _distinct_lists(
        interventions, [F.col("intervention_type"), X.left_chars("name", C.NAME_CHARS)],
        [("intervention_types", C.LIST_SEPARATOR), ("interventions", C.INTERVENTION_NAME_SEPARATOR)])


def condition_summary(conditions: DataFrame) -> DataFrame:
    """Per study: distinct 60-character condition names joined by ', '."""
    return _distinct_lists(conditions, [X.left_chars("name", C.NAME_CHARS)],
                           [("conditions", C.LIST_SEPARATOR)])


def lead_sponsor_by_study(studies: DataFrame, sponsors: DataFrame) -> DataFrame:
    """Every interventional study with its lead sponsor (null if none)."""
    return (interventional(studies).select("nct_id")
            .join(lead_sponsors(sponsors), "nct_id", "left"))


# --- the event table -----------------------------------------------------------


def upcoming_events(studies: DataFrame, sponsors: DataFrame, interventions: DataFrame,
                    conditions: DataFrame, asof: _dt.date | None = None,
                    months: int = C.TABLE_HORIZON_MONTHS, strategy: str = "explode",
                    candidates: DataFrame | None = None, join_hint: str | None = None) -> DataFrame:
    """The upcoming-milestone table (unsorted; see `sort_events`), lazy.

    `candidates` may give the rows of `upcoming_studies` from a written table
    (the report job does); else they are part of the plan. `join_hint` is put
    on the candidate ids, e.g. "merge" where a broadcast is not wanted.
    """
    months = C.check_months(months)
    cand = upcoming_studies(studies, asof, months) if candidates is None else candidates
    ids = cand.select("nct_id")
    if join_hint:
        ids = ids.hint(join_hint)

    def keep(df: DataFrame) -> DataFrame:
        # before any aggregation: only rows of candidate studies go on. How
        # they are joined is Spark's choice, from the sizes it sees.
        return df.join(ids, "nct_id", "left_semi")

    wide = (cand.join(lead_sponsors(keep(sponsors)), "nct_id", "left")
                .join(intervention_summary(keep(interventions)), "nct_id", "left")
                .join(condition_summary(keep(conditions)), "nct_id", "left"))
    return event_rows(wide, asof, months, strategy=strategy).select(*EVENT_COLUMNS)


def event_order_keys():
    """What the event table is ordered by, all ascending: date, kind in
    EVENT_ORDER (unknown kinds last), study id."""
    return [F.col("event_date"), F.coalesce(X.event_rank("event_type"), F.lit(len(C.EVENT_ORDER) + 1)), F.col("nct_id")]


def event_order_columns():
    """Total order of the event table as sort expressions."""
    return [c.asc() for c in event_order_keys()]


def page_order_keys():
    """The display page's order: date, event kind as text; then study id,
    which makes it total."""
    return [F.col("event_date"), F.col("event_type"), F.col("nct_id")]


def page_order_columns():
    """The display page's initial order: date, then event kind as text."""
    return [c.asc() for c in page_order_keys()[:2]]


def sort_events(events: DataFrame) -> DataFrame:
    """Range-partitioned global sort in the table's final order."""
    return events.orderBy(*event_order_columns())


def display_events(events: DataFrame) -> DataFrame:
    """Display view: enrollment as text with thousands separators."""
    return events.withColumn("enrollment", X.format_count("enrollment"))
